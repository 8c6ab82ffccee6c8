import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from siltworks.llm import abuse, clusters, langid, leak, pairs, repetition, textvec, trees

LONG = "word " * 60_000


# --- words ----------------------------------------------------------------------------------------------------------------


def test_words_and_hashes():
    texts = ["Hello, hello wörld 42", "", "中文 ab", "hello"]
    w = textvec.Words([t.lower() for t in texts])
    found = ["".join(map(chr, w.codes[a:b])) for a, b in zip(w.start, w.end, strict=True)]
    assert found == ["hello", "hello", "wörld", "42", "中", "文", "ab", "hello"]
    assert w.doc.tolist() == [0, 0, 0, 0, 2, 2, 2, 3]
    assert w.h[0] == w.h[1] == w.h[7] and len(set(w.h.tolist())) == 6


def test_chunks_cover_all_texts():
    texts = ["a" * 400_000, "b" * 400_000, "", "c" * 900_000, "d"]
    assert [list(range(a, b)) for a, b in textvec.chunks(texts)] == [[0], [1, 2], [3], [4]]


# --- broken pairs ---------------------------------------------------------------------------------------------------------

PROMPT = "Name the largest river of the country and describe how it was measured for the first time."


@pytest.mark.parametrize(
    ("response", "answer", "defect"),
    [
        (None, None, "empty"),
        ("", None, "empty"),
        ("​ \n", None, "empty"),
        ("TODO", None, "empty"),
        ("[answer]", None, "empty"),
        ("...", None, "empty"),
        ("<think>It is long.</think><answer></answer>", None, "empty"),
        ("<think>It is long.</think>", None, "empty"),
        ("<think>It is long and", None, "truncated"),
        ("<think>Ok.</think><answer>The river is the", None, "truncated"),
        ("<think>Ok.</think>It is long. The other one is shorter but", None, "truncated"),
        ("Code:\n```python\ndef f(x):\n    return", None, "truncated"),
        ("1. First thing.\n2.", None, "truncated"),
        ("I'm sorry, but I can't help with that.", None, "refusal"),
        ("Hmm. I do not know.", None, "refusal"),
        ("Es tut mir leid, dabei kann ich nicht helfen.", None, "refusal"),
        ("抱歉，我无法回答这个问题。", None, "refusal"),
        (PROMPT, None, "copied"),
        ("You asked: " + PROMPT.lower(), None, "copied"),
        ("Der größte Fluss ist lang, und die Messung war nicht einfach.", None, "other_language"),
        ("河流很长，测量并不容易，需要很多时间。", None, "other_language"),
        ("42", None, None),
        ("Yes", None, None),
        ("The upper river", None, None),
        ("None of them.", None, None),
        ("Sorry for the delay. The river is 20 kilometres long.", None, None),
        ("I cannot help noticing how short it is.", None, None),
        ("1. It is long\n2. It is wide", None, None),
        ("```python\ndef f():\n    return 1\n```", None, None),
        ("\\boxed{12}", None, None),
        ("x = 3", None, None),
    ],
)
def test_defects(response, answer, defect):
    found = pairs.defects(PROMPT, response, None, answer)
    assert (found[:1] or [None])[0] in ((defect,) if defect != "truncated" else ("truncated", "truncated_trace"))


def test_wanted_language_is_sound():
    assert pairs.defects("Translate the following into German: The river is long.", "Der Fluss ist lang und die Stadt ist nicht alt.", None, None) == []


def test_broken_pairs_table(spark):
    rows = [(1, PROMPT, "TODO", None, None), (1, PROMPT, "TODO", None, None), (2, None, None, None, None), (3, PROMPT, LONG, None, None), (None, PROMPT, "", None, None)]
    df = spark.createDataFrame(rows, "response_id long, prompt string, response string, reasoning string, answer string").withColumns({"rank": F.lit(1), "defect": F.lit("x")})
    assert sorted(map(tuple, pairs.primary_defects(df).collect())) == [(1, "empty"), (2, "empty"), (3, "truncated")]
    assert pairs.primary_defects(df.limit(0)).count() == 0


# --- leaks ----------------------------------------------------------------------------------------------------------------

ITEM = "In which year did the old harbour of Xelbrand pass to the guild of carpenters and what did the mayor receive for it in return"


@pytest.mark.parametrize(
    ("text", "hit"),
    [
        (f"Please: {ITEM}?", True),
        (ITEM.upper().replace(" ", "  "), True),
        ("**In which** <b>year</b> did the _old_ harbour of Xelbrand, pass to the guild of carpenters", True),
        (ITEM.replace("guild", "union").replace("mayor", "old mayor"), True),
        ("Ｉｎ ｗｈｉｃｈ ｙｅａｒ ｄｉｄ ｔｈｅ ｏｌｄ ｈａｒｂｏｕｒ ｏｆ Ｘｅｌｂｒａｎｄ ｐａｓｓ ｔｏ ｔｈｅ ｇｕｉｌｄ ｏｆ ｃａｒｐｅｎｔｅｒｓ", True),
        ("In which year did the old harbour of Tolpen burn down", False),
        ("Xelbrand", False),
        ("", False),
    ],
)
def test_leaks(spark, text, hit):
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, "")], "item_id long, question string")
    corpus = spark.createDataFrame([("a", text), ("a", text), (None, ITEM), ("n", None)], "prompt_id string, prompt string").withColumns({"id": F.lit(1), "text": F.lit("y"), "item": F.lit(1)})
    assert [tuple(r)[:2] for r in leak.leaked(corpus, "prompt_id", "prompt", items, "item_id", "question").collect()] == ([("a", 7)] if hit else [])


def test_leaks_half_an_item_with_every_fifth_word_changed(spark):
    item = [f"word{i}" for i in range(41)]
    half = [f"other{i}" if i % 5 == 3 else w for i, w in enumerate(item[10:31])]
    corpus = spark.createDataFrame([("a", "Please say " + " ".join(half) + " now."), ("b", "Please say " + " ".join(item[10:25]) + " now.")], "prompt_id string, prompt string")
    items = spark.createDataFrame([(7, " ".join(item))], "item_id long, question string")
    assert [r[0] for r in leak.leaked(corpus, "prompt_id", "prompt", items, "item_id", "question").collect()] == ["a"]


def test_common_words_bound_a_passage():
    rng = random.Random(5)
    for _ in range(200):
        a, b = (rng.choices("abcdef", k=rng.randint(1, 20)) for _ in range(2))
        d = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, j in itertools.product(range(len(a)), range(len(b))):
            d[i + 1][j + 1] = d[i][j] + 1 if a[i] == b[j] else max(d[i][j + 1], d[i + 1][j])
        assert leak.common_words(len(a), leak.word_places(a), b) == d[-1][-1] >= leak.passage(a, b)[1]


def test_leaks_short_items_only_whole(spark):
    items = spark.createDataFrame([(1, "Can Xemar outlast a linear harbour and market?")], "item_id long, question string")
    corpus = spark.createDataFrame([("a", "so: can xemar outlast a linear harbour and market"), ("b", "can xemar outlast a linear"), ("c", LONG)], "prompt_id string, prompt string")
    assert [r[0] for r in leak.leaked(corpus, "prompt_id", "prompt", items, "item_id", "question").collect()] == ["a"]
    assert leak.leaked(corpus.limit(0), "prompt_id", "prompt", items, "item_id", "question").count() == 0
    assert leak.leaked(corpus, "prompt_id", "prompt", items.limit(0), "item_id", "question").count() == 0


def test_search_finds_every_occurrence():
    rng = random.Random(3)
    alphabet = "ab c"
    patterns = {"".join(rng.choice(alphabet) for _ in range(rng.randint(4, 9))).encode(): [(i, 0)] for i in range(40)}
    text = "".join(rng.choice(alphabet) for _ in range(20_000)).encode()
    s = leak.Searcher(patterns)
    brute = {(i, s.patterns.index(p)) for p in patterns for i in range(len(text)) if text.startswith(p, i)}
    assert set(s.find(text)) == brute and len(brute) > 100


# --- repetition -----------------------------------------------------------------------------------------------------------


def brute_share(text, n=repetition.PHRASE):
    import re

    words = re.findall(r"[^\W_]+", text.lower())
    seen, hit = set(), [False] * len(words)
    for i in range(len(words) - n + 1):
        g = tuple(words[i : i + n])
        if g in seen:
            hit[i : i + n] = [True] * n
        seen.add(g)
    return sum(hit) / max(1, len(words))


def test_repetition_matches_brute_force():
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        parts = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(rng.randint(0, 60))]
        texts.append(" ".join(parts + parts[: rng.randint(0, len(parts))]))
    share = repetition.exact_shares(texts)
    for t, s in zip(texts, share, strict=True):
        assert math.isclose(s, brute_share(t), abs_tol=1e-9)


def test_repetition_ignores_case_punctuation_and_numbering():
    text = "1. The pump drives the wheel.\n2. the pump, drives the wheel!\n3. THE PUMP DRIVES THE WHEEL"
    assert repetition.exact_shares([text])[0] == pytest.approx(10 / 15)
    assert repetition.exact_shares(["wait, " * 50])[0] > 0.9
    assert repetition.exact_shares(["水泵保护着原因和结果。" * 6])[0] > 0.7
    assert repetition.exact_shares([""])[0] == 0


def test_trees_decide_and_few_texts_are_measured(monkeypatch):
    """Ablation: the trees alone, with the band, and the exact measure of everything agree on the tables' responses."""
    d = pd.read_parquet("/root/testdata/sf0.01/responses.parquet", columns=["response", "reasoning"])
    texts = [t for c in d for t in d[c] if isinstance(t, str)]
    forest = repetition.fit_scorer(texts[:600])
    exact = repetition.exact_shares(texts) >= 0.35
    measured, whole = [], repetition.exact_shares
    monkeypatch.setattr(repetition, "exact_shares", lambda t: measured.extend(t) or whole(t))
    estimate, share = repetition.decide(forest, texts, 0.35, 0.2)
    assert exact.sum() > 30 and ((estimate >= 0.35) == exact).mean() >= 0.995
    assert ((share >= 0.35) == exact).mean() >= 0.999
    assert len(measured) <= 0.05 * len(texts)


def test_repetitive_table(spark):
    loop = "The pump drives the wheel and the wheel drives the lamp. " * 6
    plain = " ".join(f"w{i}" for i in range(60))
    rows = [(1, loop, None), (1, loop, None), (2, plain, loop), (3, plain, plain), (4, None, None), (5, "", " "), (None, loop, None), (6, LONG, None)]
    df = spark.createDataFrame(rows, "response_id long, response string, reasoning string").withColumns({"id": F.lit(0), "share": F.lit(1), "field": F.lit("")})
    got = [r[0] for r in repetition.repetitive(df, "response_id", ("response", "reasoning")).collect()]
    assert sorted(got) == [1, 2, 6]
    assert repetition.repetitive(df.limit(0), "response_id", ("response", "reasoning")).count() == 0


def test_every_share_is_measured(spark):
    """No share is an estimate, and the statistics of a long text count all its phrases and words."""
    rng = random.Random(8)
    texts = []
    for _ in range(40):
        parts = ["".join(rng.choice("abcdefgh") for _ in range(3)) for _ in range(rng.randint(200, 500))]
        texts.append(" ".join(parts + parts[: rng.randint(0, len(parts))]))
    got = {r["id"]: r["share"] for r in repetition.repetition_shares(spark.createDataFrame(list(enumerate(texts)), "id long, t string"), "id", ("t",)).collect()}
    for i, t in enumerate(texts):
        assert math.isclose(got[i], brute_share(t), abs_tol=1e-9)
    for t, row in zip(texts, repetition.statistics(texts), strict=True):
        words = t.split()
        grams = list(zip(*[words[k:] for k in range(repetition.PHRASE)]))
        assert math.isclose(row[0], 1 - len(set(grams)) / len(grams)) and math.isclose(row[4], 1 - len(set(words)) / len(words))


def test_trees_fit_and_stay_monotonic():
    rng = np.random.default_rng(2)
    x = rng.random((2000, 3))
    y = x[:, 0] ** 2 + 0.3 * np.sin(6 * x[:, 1]) + rng.normal(0, 0.05, 2000)
    f = trees.fit(x, y, monotonic=(0,))
    assert np.abs(f.score(x) - y).mean() < 0.08
    grid = np.tile(rng.random((50, 1, 3)), (1, 30, 1))
    grid[:, :, 0] = np.linspace(0, 1, 30)
    assert (np.diff(f.score(grid.reshape(-1, 3)).reshape(50, 30), axis=1) >= -1e-9).all()
    assert trees.fit(np.zeros((0, 2)), np.zeros(0)).score(np.ones((3, 2))).tolist() == [0, 0, 0]


# --- languages ------------------------------------------------------------------------------------------------------------

SAMPLES = {
    "en": ["The pump of the old mill drives a wheel", "Every second valve stays closed during the night", "What happens to the lamp after the test", "Neither the guard nor the clerk saw the ledger"],
    "de": ["Die Pumpe der alten Mühle treibt ein Rad", "Jedes zweite Ventil bleibt in der Nacht geschlossen", "Was passiert nach der Prüfung mit der Lampe", "Weder der Wächter noch der Schreiber sah das Buch"],
    "ru": ["Насос старой мельницы вращает колесо", "Каждый второй клапан ночью закрыт", "Что происходит с лампой после проверки", "Ни сторож, ни писарь не видели книгу"],
}


def labelled_texts():
    rng = random.Random(1)
    rows = []
    for i in range(240):
        l = ("en", "de", "ru")[i % 3]
        rows.append((f"t{i:03d}", ". ".join(rng.sample(SAMPLES[l], 3)) + ".", {"en": "English", "de": "de-DE", "ru": "ru"}[l]))
    return rows


def test_language_notations():
    assert [langid.language_code(x) for x in ("en-US", " EN ", "English", "swe", "??", "", None, "und", "Portuguese", "zh_CN")] == ["en", "en", "en", "sv", None, None, None, None, "pt", "zh"]


def test_segments_leave_out_code_and_quotations():
    s = [x for _, x in langid.segments('Use `def f(x)` here today. The note says "entre duas inspeções" twice. OK')]
    assert len(s) == 2 and not any("def" in x or "entre" in x for x in s)


def test_mislabelled(spark):
    rows = labelled_texts()
    mixed = SAMPLES["en"][0] + ". " + SAMPLES["de"][1] + "."
    rows += [("wrong", SAMPLES["de"][0] + ".", "en"), ("none", SAMPLES["ru"][0] + ".", None), ("odd", SAMPLES["en"][1] + ".", "n/a"), ("mixed", mixed, "en"), ("mixed", mixed, "en"), ("nul", None, "en"), (None, mixed, "en"), ("empty", "", "en"), ("long", "The pump drives the wheel. " * 3000, "en")]
    df = spark.createDataFrame(rows, "prompt_id string, prompt string, language string").withColumns({"id": F.lit(0), "label": F.lit("x"), "text": F.lit("y")})
    got = sorted(map(tuple, langid.mislabelled(df, "prompt_id", "prompt", "language").collect()))
    assert got == [("mixed", "de"), ("mixed", "en"), ("none", "ru"), ("odd", "en"), ("wrong", "de")]
    assert langid.mislabelled(df.limit(0), "prompt_id", "prompt", "language").count() == 0
    assert langid.mislabelled(df.withColumn("language", F.lit(None).cast("string")), "prompt_id", "prompt", "language").count() == 0


def test_language_model_on_held_out_sentences():
    rows = labelled_texts()
    m = langid.fit_from_rows([t for _, t, _ in rows], [langid.language_code(l) for _, _, l in rows])
    held_out = [("The clerk closed the old valve after the night", "en"), ("Der Schreiber schloss das alte Rad nach der Nacht", "de"), ("Сторож закрыл старый клапан ночью", "ru")]
    best = m.score([t for t, _ in held_out]).argmax(1)
    assert [m.languages[k] for k in best] == [l for _, l in held_out]


# --- abuse ----------------------------------------------------------------------------------------------------------------

SOUND = ["The pump of the mill drives the wheel.", "Breast cancer screening is offered every two years.", "Kill the child process before the parent exits.", "The word idiot comes from an old term.", "Foreigners pay the same fare as everyone else."]
BAD = ["Go to hell, you filthy moron.", "Shut your mouth, bastard.", "You are such a worthless s.c.u.m.b.a.g.", "Only a pathetic 1d10t like you would ask.", "Those foreigners are vermin and have to go.", "His cock was hard and she begged him to fuck her.", "Halt die Fresse, du Drecksau.", "滚开，你这个垃圾。", "I hope you choke on it and die there.", "What a filthy m***n you are."]


def abuse_docs(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choices(SOUND, k=6)), "s%d" % (i % 3)) for i in range(300)]
    rows += [(1000 + i, f"{rng.choice(SOUND)} {b} {rng.choice(SOUND)}", "bad") for i, b in enumerate(BAD)]
    rows += [(2000, None, None), (2001, "", None), (None, BAD[0], "x"), (1000, rows[300][1], "bad"), (2002, SOUND[0] * 4000, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"id": F.lit(0), "score": F.lit(1.0), "n": F.lit(1)})


def test_abusive(spark):
    df = abuse_docs(spark)
    assert sorted(r[0] for r in abuse.abusive(df, "doc_id", "text").collect()) == [1000 + i for i in range(len(BAD))]
    rates = {r["source"]: r["rate"] for r in abuse.rates(df, "doc_id", "text", "source").collect()}
    assert rates["bad"] == 1.0 and rates["s0"] == 0 and rates[None] == 0
    assert abuse.abusive(df.limit(0), "doc_id", "text").count() == 0


def test_undisguise():
    for t, w in (("you m o r o n lol", "moron"), ("a s.c.u.m.b.a.g", "scumbag"), ("m***n", "moron"), ("b1tch", "bitch"), ("duuumbass", "dumbass"), ("$cumb@g", "scumbag")):
        assert f" {w} " in (abuse.undisguise(t) or ""), t
    assert abuse.undisguise("27t^2 and v * 3 for x_1 a b c") is None


def test_label_model_recovers_the_labels():
    rng = np.random.default_rng(6)
    y = rng.random(20_000) < 0.05
    votes = np.zeros((len(y), 4), np.int8)
    for j, (hit, false) in enumerate([(0.7, 0.002), (0.5, 0.001), (0.6, 0.003)]):
        votes[:, j] = rng.random(len(y)) < np.where(y, hit, false)
    votes[:, 3] = -(rng.random(len(y)) < np.where(y, 0.05, 0.9)).astype(np.int8)
    p = abuse.fit_label_model(votes).posterior(votes)
    assert ((p > 0.5) == y).mean() > 0.985


# --- clusters -------------------------------------------------------------------------------------------------------------

NOUNS = [a + b for a, b in itertools.product(["pum", "lam", "ster", "vol", "gra", "nel", "tor", "bis"], ["per", "dor", "net", "lus", "mik", "ran"])]


def cluster_rows(groups=25, singles=150, seed=7):
    rng = random.Random(seed)

    def statement():
        a, b, c, d = rng.sample(NOUNS, 4)
        return f"the {a} of {b} keeps {rng.randint(100, 9999)} {c} near the {d}"

    rows, truth = [], {}
    for g in range(groups):
        base = [statement() for _ in range(4)]
        for v in range(rng.randint(2, 5)):
            s = base[:]
            rng.shuffle(s)
            if v % 2:
                s[0] = s[0].replace("keeps", "holds")
            i = f"g{g:02d}v{v}"
            truth.setdefault(g, []).append(i)
            rows.append((i, ("Please help. " if v else "") + ". ".join(x.capitalize() for x in s) + "."))
    rows += [(f"s{i:03d}", ". ".join(statement() for _ in range(4)) + ".") for i in range(singles)]
    return rows, truth


def test_clusters_find_the_groups(spark):
    rows, truth = cluster_rows()
    rows += [("g00v0", rows[0][1]), ("copy1", rows[0][1]), ("nul", None), (None, "x"), ("empty", ""), ("word", "alone")]
    df = spark.createDataFrame(rows, "prompt_id string, prompt string").withColumns({"id": F.lit(0), "node": F.lit(1), "cluster": F.lit(2), "text": F.lit("")})
    got = clusters.similarity_clusters(df, "prompt_id", "prompt")
    groups = {}
    for r in got.collect():
        groups.setdefault(r["cluster"], set()).add(r["prompt_id"])
    want = [set(v) | ({"copy1"} if g == 0 else set()) for g, v in truth.items()]
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want))
    pairs_ = clusters.cluster_pairs(got, "prompt_id")
    assert pairs_.count() == sum(len(v) * (len(v) - 1) // 2 for v in want)
    summary = {r["cluster"]: r for r in clusters.cluster_summary(got, "prompt_id").collect()}
    assert all(summary[min(v)]["size"] == len(v) and set(summary[min(v)]["exemplars"]) <= v for v in want)
    again = clusters.similarity_clusters(df.repartition(6), "prompt_id", "prompt")
    assert sorted(tuple(r)[:2] for r in again.collect()) == sorted(tuple(r)[:2] for r in got.collect())


def test_clusters_keep_a_hot_group_whole(spark):
    # A third of the texts are variants of one, each with words of its own in one of its sentences.
    rng = random.Random(3)
    base = ["the amber valve of the mill turns seven grey wheels at noon", "a copper siphon beside the lock drains ninety shallow basins", "his wooden ledger lists every barge under the stone arch", "one narrow sluice feeds the lower pond before each harvest"]
    rows = []
    for v in range(120):
        s = [x.split() for x in base]
        for k in rng.sample(range(9), 2):
            s[v % 4][k] = f"own{v}x{k}"
        rows.append((f"h{v:03d}", ". ".join(" ".join(x) for x in s) + "."))
    rows += [(f"s{i:03d}", ". ".join(" ".join(f"w{rng.randrange(4000)}" for _ in range(10)) for _ in range(4)) + ".") for i in range(240)]
    got = clusters.similarity_clusters(spark.createDataFrame(rows, "prompt_id string, prompt string"), "prompt_id", "prompt").collect()
    assert sorted((r["prompt_id"], r["cluster"]) for r in got) == [(f"h{v:03d}", "h000") for v in range(120)]


def test_clusters_empty(spark):
    df = spark.createDataFrame([("a", None)], "prompt_id string, prompt string")
    assert clusters.similarity_clusters(df, "prompt_id", "prompt").count() == 0
    assert clusters.similarity_clusters(df.limit(0), "prompt_id", "prompt").count() == 0


def test_spanning_forest_matches_kruskal(spark):
    rng = random.Random(11)
    edges = [(a, b, round(rng.random(), 3)) for a in range(40) for b in range(a + 1, 40) if rng.random() < 0.12]
    forest, labels = clusters.spanning_forest(spark.createDataFrame(edges, "a long, b long, d double"))
    head = list(range(40))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    want = []
    for a, b, d in sorted(edges, key=lambda e: (e[2], e[0], e[1])):
        if find(a) != find(b):
            head[find(a)] = find(b)
            want.append((a, b, d))
    assert sorted(map(tuple, forest.collect())) == sorted(want)
    root = {r["node"]: r["root"] for r in labels.collect()}
    assert all((root[a] == root[b]) == (find(a) == find(b)) for a in root for b in root)


def test_condense_splits_loose_parents_and_keeps_tight_ones():
    # Two dense leaves that meet far away stay apart.
    assert condensed({1: (5, 50.0), 2: (4, 44.0)}, [(0.74, 1, 2)]) == {1: 1, 2: 2}
    # Loose leaves that meet at once are one cluster.
    assert condensed({1: (2, 2.9), 2: (2, 2.9)}, [(0.70, 1, 2)]) == {1: 1, 2: 1}
    # A single point that joins above epsilon belongs to no cluster.
    assert condensed({1: (3, 9.0), 7: (1, 1.4)}, [(0.72, 1, 7)]) == {1: 1}


def condensed(leaves, merges):
    return clusters.condense(leaves, merges, 1 / 0.75)
