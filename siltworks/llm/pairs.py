"""Broken prompt and response pairs (problem 2).

Ordered rules over one row at a time: emptiness, unclosed delimiters and open traces, multilingual refusals, copied
prompts, abrupt endings, script and language mismatch. The operator emits every defect a row triggers with the rule's
rank; the primary defect of a response is the one of the lowest rank. Nothing is shuffled but the (id, defect) rows.

Nulls: a row without an id is left out; null prompt, response, reasoning or answer count as absent text. A row with no
text at all is ``empty``. Whole texts are read, whatever their length. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Defects in the order of the rules.
DEFECTS = ("empty", "truncated_trace", "refusal", "copied", "truncated", "other_language")

# Words of each language that carry grammar rather than matter.
FUNCTION_WORDS = {
    "en": "a i the of and is that for with to in was are this from by which than or their its has have had not be an it but as at on there you how what when",
    "de": "der die das und ist nicht ein eine einen dem den des mit auf für von zu aber nach ohne unter zwischen wenn wie oder auch sich seit trotz laut gegen im am vor",
    "fr": "le la les et est une un dans pour des du que qui avec sur pas ce cette mais sans après entre selon sous malgré depuis au aux avant cet quand ne se",
    "es": "el la los las y es una un en para del que con por no su pero sin según entre tras bajo desde pese más al este esta antes cada cuando qué",
    "pt": "o a os as e é uma um em para do da que com por não seu mas sem segundo entre após sob desde apesar mais no na este esta antes cada ao dos das pelo",
    "sv": "och är en ett i på av för med som det att den men utan efter mellan under enligt sedan trots mot varje samma vid inte till över från de mer",
    "fi": "ja on ei se että mutta kun joka kuin myös ilman ennen jälkeen mukaan kahden sekä tai vain jos niin huolimatta lopussa aikana lähtien kaikissa samassa",
}
# How a prompt may name the language that it wants.
LANGUAGE_NAMES = {
    "en": "english englisch anglais inglés inglês engelska englanti englanniksi английск 英语 英文",
    "de": "german deutsch allemand alemán alemão tyska saksa saksaksi немецк 德语 德文",
    "fr": "french französisch français francés francês franska ranska ranskaksi французск 法语 法文",
    "es": "spanish spanisch espagnol español castellano espanhol spanska espanja espanjaksi испанск 西班牙语",
    "pt": "portuguese portugiesisch portugais portugués português portugisiska portugali portugaliksi португальск 葡萄牙语",
    "sv": "swedish schwedisch suédois sueco svenska ruotsi ruotsiksi шведск 瑞典语",
    "fi": "finnish finnisch finnois finlandés finlandês finska suomi suomeksi финск 芬兰语",
    "ru": "russian russisch russe ruso russo ryska venäjä venäjäksi русск 俄语 俄文",
    "zh": "chinese mandarin chinesisch chinois chino chinês kinesiska kiina kiinaksi китайск 中文 汉语",
}
# Texts that only stand in for an answer.
STAND_INS = frozenset(
    x.strip()
    for x in (
        "todo, tbd, tba, fixme, n/a, na, null, nil, nan, undefined, answer, response, output, result, placeholder, empty, blank, pending, xxx, xx, ???, lorem ipsum, your answer here, answer here, insert answer here, "
        "insert answer, no answer, no response, to be done, to do, coming soon, answer goes here, final answer, write answer here, fill in, to be filled, not available, text here, none given"
    ).split(",")
)

# What a sentence that only declines looks like, by language.
REFUSALS = (
    r"\b(?:can ?not|can'?t|could ?n[o']t|won'?t|will not|unable to|not able to|not allowed to|must not|may not|not permitted to)\b[^.!?]*\b(?:help|assist|answer|respond|comply|fulfil|fulfill|provide|continue|discuss|complete|do (?:that|this)|engage|share|support|process|talk)\b(?! noticing| but)",
    r"\b(?:i|we)\b[^.!?]*\b(?:must|have to|need to|would like to|will|want to|am going to|am forced to)\b[^.!?]*\b(?:decline|refuse|pass|abstain|reject)\b",
    r"^(?:i (?:decline|refuse|pass)|no comment|request (?:declined|denied|refused))\b",
    r"not something i(?: can|'m able| am)",
    r"\bi(?:'d| would| will)? (?:rather|prefer|prefer to) not\b",
    r"\b(?:guidelines|policy|policies|rules|instructions|training)\b[^.!?]*\b(?:prevent|forbid|prohibit|do(?:es)? not allow|don'?t allow|do(?:es)? not permit|stop)",
    r"not be (?:appropriate|right|proper|possible) for me\b",
    r"beyond what i(?: am|'m| can)\b",
    r"too (?:complex|hard|difficult|much|sensitive) for me\b",
    r"^(?:sorry,? |well,? )?i (?:do not|don'?t|dont|have no) (?:know|idea)(?: the answer(?: to (?:this|that)(?: question)?)?)?$",
    r"\bas an? (?:ai|language model|assistant)\b[^.!?]*\b(?:not|unable|decline|refuse)\b",
    r"tut mir leid|kann ich (?:\w+ )?nicht (?:helfen|beantworten|weiterhelfen)|ich kann (?:\w+ ){0,4}nicht (?:helfen|beantworten|weiterhelfen)|darf ich (?:\w+ )?(?:nicht|keine)|möchte ich (?:\w+ )?(?:nicht|lieber nicht)|ich muss (?:\w+ ){0,4}ablehnen|ablehnen muss|lehne ich ab|als (?:sprachmodell|ki)\b",
    r"je (?:ne|n'|préfère|refuse|dois|suis|regrette)\b[^.!?]*(?:peux|puis|pas|refus|décli|désolé)|désolée?\b|en tant (?:que modèle|qu'ia)|il (?:ne )?m'est (?:pas |im)|impossible (?:pour moi|de répondre|de vous aider)",
    r"lo siento\b|no (?:puedo|podré) (?:\w+ ){0,3}(?:ayudar|responder|contestar|atender|hablar|cumplir)|prefiero no\b|no me (?:está|es) permitido|(?:debo|tengo que) (?:rechazar|negarme|declinar)|me niego a|como modelo de lenguaje",
    r"não (?:posso|consigo|poderei) (?:\w+ ){0,3}(?:ajudar|responder|atender|falar|cumprir)|prefiro não\b|não me é permitido|não (?:tenho|estou) (?:permissão|autorizado)|(?:devo|tenho de|tenho que|preciso) recusar|(?:peço )?desculpe?a?s?,|lamento,|como modelo de linguagem|recuso-me",
    r"jag (?:får|kan|vill|kommer) (?:tyvärr |helst )?inte\b|måste (?:jag )?(?:tyvärr )?(?:avböja|neka|tacka nej|avstå)|jag måste (?:\w+ )?(?:avböja|neka|avstå)|jag (?:avstår|avböjer)|som språkmodell|tyvärr (?:kan|får|måste) jag",
    r"\ben (?:voi|saa|halua|osaa|pysty|aio) (?:\w+ ){0,3}(?:auttaa|vastata|käsitellä|puhua|tehdä|keskustella|jatkaa)|(?:täytyy|pitää|joudun) (?:\w+ )?kieltäy|kieltäydyn|kielimallina|haluaisin olla vastaamatta|en voi auttaa|mieluummin (?:en|ole)",
    r"не (?:могу|смогу|буду|стану|имею права|вправе|в силах)\b[^.!?]*|мне нельзя|(?:вынужден|вынуждена|должен|должна) отказ|предпоч\w+ не\b|отказываюсь|как языковая модель|не хочу (?:об этом|отвечать|обсуждать)",
    r"(?:抱歉|对不起|很遗憾|不好意思).*(?:无法|不能|拒绝|不便|没办法|不可以)|我(?:无法|不能|拒绝|必须拒绝|不想|不便|不可以)|作为.{0,6}(?:语言模型|人工智能|助手).*(?:不|无)|不(?:方便|允许|愿意?)(?:回答|讨论|谈论)|宁愿不",
)
# What may stand beside a refusal without adding an answer.
FILLERS = r"^(?:thanks?(?: you)?(?: for \w+(?: \w+)?)?|hmm+|hm|well|sorry|unfortunately|regrettably|hello|hi|okay|ok|good question|apologies|please (?:ask|try|choose) (?:me )?(?:something|anything|another)[^.!?]*|wow|so|oh|i (?:apologi[sz]e|am sorry|'m sorry)|i'm sorry|my apologies|danke|merci|gracias|obrigado|tack|kiitos|спасибо|извините|к сожалению|leider|désolé|lo siento|desculpe|tyvärr|valitettavasti|anteeksi|抱歉|对不起|谢谢)$"

_REFUSAL = re.compile("|".join(f"(?:{p})" for p in REFUSALS))
_FILLER = re.compile(FILLERS)
_WORD = re.compile(r"[\u3040-\u30ff\u3400-\u9fff]|[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+|(?<=[。！？])|\n+")
_PROMPT_PART = re.compile(r"(?<=[.!?…:])\s+|(?<=[。！？])|\n+")
_TERMINAL = ".!?。！？…)]}\"'»”’`|;）】」』"
_ITEM = re.compile(r"(?m)^\s*(?:\d+[.)]|[-*•])(?:\s|$)")
_LONE_ITEM = re.compile(r"(?:^|\n)\s*(?:\d+[.)]|[-*•])\s*$")
_TAG_THINK = re.compile(r"<\|?\s*(/?)\s*(?:think|thinking|thought|reasoning|analysis)\s*\|?>", re.I)
_TAG_ANSWER = re.compile(r"<\|?\s*(/?)\s*(?:answer|final|response|output)\s*\|?>", re.I)
_LEAD_IN = re.compile(r"^(?:you asked|your question|question|q|prompt|the prompt|user|you said)\s*[.:]\s*", re.I)
_SCRIPTS = {"ru": re.compile(r"[\u0400-\u04ff]"), "zh": re.compile(r"[\u3400-\u9fff]")}
_HANGING = frozenset(
    "a an the of and or but if because that which with without to for from in into on at by as so than when while whose where since until unless there is are was were be has have had its their our this another each "
    "der die das den dem des ein eine einen und oder aber weil dass mit ohne für von zu im am auf nach unter zwischen "
    "le la les un une des du et ou mais que qui dans pour avec sans sur sous selon ce cette "
    "el los las una y o pero del en con sin por para según si porque "
    "os as uma e ou mas do da dos das em no na com sem por para se porque "
    "och eller men att som med utan på av för till från vid om den det en ett ja tai mutta että kun jos koska "
    "и или но что если потому с без в на к по для от из при когда".split()
)
_FENCE = "```"
_CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`", re.S)
_BY_WORD: dict[str, list[str]] = {}
for _l, _w in FUNCTION_WORDS.items():
    for _x in _w.split():
        _BY_WORD.setdefault(_x, []).append(_l)
_LETTERS = {"ß": "de", "ñ": "es", "¿": "es", "¡": "es", "ã": "pt", "õ": "pt", "å": "sv", "è": "fr", "ê": "fr", "œ": "fr", "ù": "fr"}
_NAMES = re.compile("|".join(rf"(?P<{l}>{'|'.join(n.split())})" for l, n in LANGUAGE_NAMES.items()))


def visible(text: str | None) -> str:
    """The text without blanks at its ends and without invisible characters."""
    if not text:
        return ""
    if not text.isascii():
        text = "".join(c for c in text if unicodedata.category(c) not in ("Cf", "Cc", "Co", "Cn") or c in "\n\t") if any(not c.isprintable() for c in text) else text
        text = text.replace("\u3164", " ").replace("\u2800", " ").replace("\u115f", " ").replace("\u1160", " ")
    return text.strip()


def answer_of(response: str | None, answer: str | None) -> tuple[str, bool, bool]:
    """(what is given as the answer, a trace is open, the answer's tag is open)."""
    r = response or ""
    open_trace = open_answer = False
    rest = r
    if "<" in r:
        last = None
        for last in _TAG_THINK.finditer(r):
            pass
        tags = list(_TAG_ANSWER.finditer(r, last.end() if last and last[1] else 0))
        opens = [m for m in tags if not m[1]]
        if last and not last[1]:
            open_trace, rest = not opens, ""
            if open_trace:
                rest = r[last.end() :]
        elif last:
            rest = r[last.end() :]
        if opens:
            m = opens[-1]
            close = next((t for t in tags if t[1] and t.start() >= m.end()), None)
            open_answer = close is None
            rest = r[m.end() : close.start() if close else len(r)]
    if answer is not None:
        return answer, open_trace, open_answer
    return ("" if open_trace else rest), open_trace, open_answer


def votes(text: str) -> dict[str, float]:
    """Evidence for each language."""
    out: dict[str, float] = {}
    low = text.lower()
    if not low.isascii():
        for l, p in _SCRIPTS.items():
            if n := len(p.findall(low)):
                out[l] = n / (1.5 if l == "zh" else 5)
        for c, l in _LETTERS.items():
            if n := low.count(c):
                out[l] = out.get(l, 0) + min(n, 4)
    for w in _WORD.findall(low):
        if ls := _BY_WORD.get(w):
            for l in ls:
                out[l] = out.get(l, 0) + 1 / len(ls)
        elif len(w) > 6 and w.endswith(("ee", "aa", "ää", "eä", "iä", "oa", "öä", "uu")):
            out["fi"] = out.get("fi", 0) + 0.4
        elif len(w) > 5 and w.endswith(("ssa", "ssä", "sta", "stä", "lla", "llä", "uutta", "yttä", "taa", "tää", "nsa", "oaa", "ksen")):
            out["fi"] = out.get("fi", 0) + 0.5
    return out


def language_of(text: str) -> str | None:
    """The language of a text, null where the evidence is thin or divided."""
    v = sorted(votes(text).items(), key=lambda x: -x[1])
    if not v or v[0][1] < 1.5 or len(v) > 1 and v[0][1] < 1.4 * v[1][1]:
        return None
    return v[0][0]


def languages_in(prompt: str) -> set[str]:
    """Every language that some sentence of a prompt may be in, on whatever evidence there is; where a sentence may be in
    one or another, the one of which the whole prompt has more."""
    out: set[str] = set()
    whole = votes(prompt)
    for s in _PROMPT_PART.split(prompt):
        v = votes(s)
        if v and (top := max(v.values())) >= 0.5:
            out.add(max((l for l, n in v.items() if n >= 0.7 * top), key=lambda l: (whole.get(l, 0), l)))
    return out


def only_declines(text: str) -> bool:
    if _FENCE in text:
        return False
    low = re.sub(r"\s+", " ", text.lower().replace("\u2019", "'"))
    said = False
    for s in _SENTENCE.split(low):
        s = s.strip(" .!?,;:*_\"'。！？，“”>-")
        if not s or _FILLER.match(s):
            continue
        if not _REFUSAL.search(s):
            return False
        said = True
    return said


def _covered(a: list[str], b: set[tuple[str, ...]], n: int) -> float:
    hit = bytearray(len(a))
    for i in range(len(a) - n + 1):
        if tuple(a[i : i + n]) in b:
            hit[i : i + n] = b"\1" * n
    return sum(hit) / len(a)


def gives_back(prompt: str, text: str) -> bool:
    """The text is the prompt or most of it, apart from slight changes."""
    text = _LEAD_IN.sub("", text.lstrip("> \"'*\n"))
    if not text or not prompt:
        return False
    a, p = _WORD.findall(unicodedata.normalize("NFKC", text).lower()), _WORD.findall(unicodedata.normalize("NFKC", prompt).lower())
    if len(a) < 4 or not p or len(set(a) & set(p)) < 0.7 * len(set(a)) or len(a) < 0.4 * len(p):
        return False
    n = 2 if len(a) < 8 else 3
    ga, gp = {tuple(a[i : i + n]) for i in range(len(a) - n + 1)}, {tuple(p[i : i + n]) for i in range(len(p) - n + 1)}
    return _covered(a, gp, n) >= 0.7 and _covered(p, ga, n) >= 0.5


def breaks_off(text: str) -> bool:
    """The text ends before its end: an unclosed fence or box, a lone item mark, or a last sentence that isn't ended."""
    if text.count(_FENCE) % 2:
        return True
    if _LONE_ITEM.search(text):
        return True
    if text.endswith(_FENCE):
        return False
    if re.search(r"\\boxed\{[^{}]*$|\\frac\{[^{}]*$", text):
        return True
    last = text[-1]
    words = _WORD.findall(text)
    if last in _TERMINAL:
        return False
    if not words or re.fullmatch(r"[\d\s.,:/%+\-=x*^()$\\{}a-z]{0,24}", text) and any(c.isdigit() for c in text):
        return False
    hanging = words[-1].lower() in _HANGING and len(words) > 2
    items = list(_ITEM.finditer(text))
    if items and items[-1].start() >= text.rfind("\n"):
        before = [x.strip() for x in text[: items[-1].start()].split("\n") if _ITEM.match(x)]
        ended = sum(x[-1] in ".!?。！？" for x in before)
        return hanging or bool(before) and ended > len(before) / 2 or len(_WORD.findall(text[items[-1].end() :])) < 2
    if hanging:
        return True
    return len(words) > 6 or any(c in ".!?。！？" for c in text[:-1])


def defects(prompt: str | None, response: str | None, reasoning: str | None, answer: str | None) -> list[str]:
    """Every defect that the row triggers, in the order of the rules."""
    given, open_trace, open_answer = answer_of(response, answer)
    text = visible(given)
    if not text:
        trace = visible(_TAG_THINK.sub("", response or "")) or visible(reasoning)
        return ["truncated_trace"] if open_trace and trace else ["empty"]
    bare = re.sub(r"[\s\[\](){}<>*_.\"'`:…#-]+", " ", text.lower()).strip()
    if not bare or bare in STAND_INS or not any(c.isalnum() for c in bare) and len(text) < 12:
        return ["empty"]
    out = []
    if open_trace:
        out.append("truncated_trace")
    if only_declines(text):
        out.append("refusal")
    if prompt and gives_back(prompt, text):
        out.append("copied")
    if open_answer or breaks_off(text):
        out.append("truncated")
    if prompt:
        prose = _CODE.sub(" ", text)
        own = language_of(prose)
        if own:
            written = languages_in(prompt)
            # Without any evidence of the prompt's language, its script still tells.
            other_script = not written and own in _SCRIPTS and any(c.isalpha() for c in prompt) and not _SCRIPTS[own].search(prompt)
            if (other_script or written and own not in written) and not any(m.lastgroup == own for m in _NAMES.finditer(prompt.lower())):
                out.append("other_language")
    return out


def _flag(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        ids, found = [], []
        for i, p, r, g, a in zip(b["response_id"], b["prompt"], b["response"], b["reasoning"], b["answer"], strict=True):
            for d in defects(p, r, g, a):
                ids.append(i)
                found.append(d)
        yield pd.DataFrame({"response_id": pd.Series(ids, dtype="int64"), "rank": pd.Series([DEFECTS.index(d) for d in found], dtype="int32"), "defect": pd.Series(found, dtype="object")})


def broken_pairs(responses: DataFrame) -> DataFrame:
    """(response_id, rank, defect) for every defect of every response; once each, however often the row repeats."""
    cols = [F.col(c).cast("string").alias(c) for c in ("prompt", "response", "reasoning", "answer")]
    narrow = responses.where(F.col("response_id").isNotNull()).select(F.col("response_id").cast("long").alias("response_id"), *cols)
    return narrow.mapInPandas(_flag, "response_id long, rank int, defect string").distinct()


def primary_defects(responses: DataFrame) -> DataFrame:
    """(response_id, defect): of each defective response the defect whose rule comes first; an open trace is ``truncated``."""
    first = broken_pairs(responses).groupBy("response_id").agg(F.min_by("defect", "rank").alias("defect"))
    return first.withColumn("defect", F.when(F.col("defect") == "truncated_trace", "truncated").otherwise(F.col("defect")))
