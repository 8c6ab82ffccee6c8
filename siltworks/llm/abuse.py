"""Abusive, hateful or sexual content (problem 10).

Weak supervision over sentences. Voters made of general lexicons and of rules on how their words stand together (an insult
near a word of address, a group with a dehumanising predicate, an announcement of harm to someone addressed) say abusive,
sound or nothing of each sentence. A generative label model estimates by expectation-maximisation how often each voter is
right under either label, and how far pairs of voters agree beyond what the label explains; correlated voters are
discounted accordingly. A linear classifier on words, word pairs and votes is then trained on the posterior labels, and it
alone scores: a document's score is that of its worst sentence. Every training sentence with votes is shown a second time
without them, so that the classifier also learns from words what no voter knows.

Words in disguise (doubled letters, digits for letters, stars, spaced or dotted letters) are read as what they stand for.

The label model is fitted on the counts of all vote patterns over all documents (two to the number of voters at most, in
practice some hundreds). The classifier is fitted on the driver on a bounded sample: of the ``pool_rows`` documents with the
lowest hash of their id, at most ``fit_sentences`` sentences of which some voter says abusive and twice as many others, by
lowest hash. No text is shuffled but the sample's sentences.

Nulls: a null id is left out; a null or empty text scores 0; a null source is a source of its own. Repeated ids keep their
highest score. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltworks.llm import textvec
from siltworks.session import stored

# General lexicons by language. Phrases of one to four words, separated by commas; FORMS makes their endings.
INSULTS = {
    "en": "moron, idiot, imbecile, cretin, dimwit, halfwit, nitwit, dunce, dolt, numbskull, blockhead, simpleton, scumbag, scum, asshole, arsehole, bastard, bitch, dumbass, jackass, twat, prick, dickhead, douchebag, retard, slut, whore, cunt, motherfucker, wanker, pervert, lowlife, degenerate, piece of shit, pieces of shit, piece of crap, sack of shit, waste of space, waste of oxygen, son of a bitch, sons of bitches",
    "de": "idiot, vollidiot, trottel, depp, dummkopf, blödmann, mistkerl, miststück, drecksau, drecksack, arschloch, arschlöcher, wichser, schlampe, hurensohn, missgeburt, versager, abschaum, penner, spast, hure, schwachkopf, nichtsnutz, dumme kuh, blöde kuh",
    "fr": "imbécile, crétin, abruti, connard, connasse, salope, salaud, enculé, débile, ordure, raté, minable, bouffon, pute, sous merde, fils de pute, pauvre type, pauvre con, bon à rien",
    "es": "idiota, imbécil, estúpido, inútil, cabrón, cabrones, gilipollas, pendejo, maricón, escoria, malnacido, tarado, cretino, capullo, subnormal, desgraciado, hijo de puta, hija de puta",
    "pt": "imbecil, otário, babaca, vagabunda, escroto, desgraçado, canalha, filho da puta, lixo humano",
    "sv": "förlorare, nolla, tönt, slusk, jävel, kärring, äckel, kräk, fitta, dumskalle, fårskalle, luder, rövhål, avskum",
    "fi": "kusipää, luuseri, idiootti, paskiainen, huora, mulkku, ääliö, tollo, typerys, mäntti, pölvästi",
    "ru": "тварь, ничтожество, мудак, идиот, дебил, урод, сука, ублюдок, придурок, кретин, скотина, мразь, тупица, козёл, сволочь, дура, дурак, шлюха, подонок",
    "zh": "混蛋, 白痴, 傻逼, 蠢货, 废物, 贱人, 笨蛋, 王八蛋, 畜生, 婊子, 人渣, 傻瓜, 蠢猪",
}
MILD = {
    "en": "pig, swine, cow, rat, snake, worm, clown, fool, liar, trash, garbage, failure, disgrace, creep, loser, coward, jerk, weakling, monkey, donkey, parasite",
    "de": "schwein, lügner, feigling, esel, ratte", "fr": "menteur, lâche, porc, clown", "es": "zorra, basura, payaso, mentiroso, cerdo, rata, tonto",
    "pt": "verme, palhaço, burro, lixo, porco, idiota, cretino, corno", "sv": "svin, lögnare, fegis, idiot", "fi": "sika, pelle, valehtelija, hölmö, paska", "ru": "свинья, крыса, трус, лжец, скот", "zh": "垃圾, 懦夫, 猪, 骗子",
}
SCORN = {
    "en": "filthy, worthless, pathetic, disgusting, spineless, ugly, brainless, stupid, miserable, dumb, useless, vile, goddamn, fucking, damned, bloody, lousy, braindead, retarded, nasty, repulsive, hopeless, rotten, stinking, ignorant, idiotic, moronic",
    "de": "widerlich, erbärmlich, dumm, blöd, dreckig, elend, verdammt, wertlos, hässlich, ekelhaft", "fr": "sale, stupide, minable, pathétique, dégoûtant, gros, espèce de, espèce d", "es": "de mierda, asqueroso, maldito, patético, despreciable, repugnante, puto",
    "pt": "de merda, nojento, maldito, patético, imundo, desprezível, seu merda", "sv": "äcklig, värdelös, jävla, dum, ful, patetisk", "fi": "säälittävä, typerä, vitun, saatanan, senkin, surkea, ruma", "ru": "мерзк, жалк, туп, поган, гнусн, вонюч", "zh": "恶心, 愚蠢, 没用, 该死, 下贱, 可悲",
}
ADDRESS = {
    "en": "you, your, yours, you're, youre, yourself, ur", "de": "du, dich, dir, dein, deine, deiner, deinem, deinen, euch", "fr": "tu, toi, te, ta, ton, tes, t'es, vous", "es": "tú, tu, eres, vete, tus, te, usted, ti", "pt": "você, seu, sua, tu, te, vai, és",
    "sv": "du, din, ditt, dig, dina, ni", "fi": "sinä, sinun, sinut, sinua, olet, teidät, sä", "ru": "ты, тебя, тебе, твой, твоя, тобой, вас", "zh": "你, 你们, 您",
}
DISMISSAL = {
    "en": "shut up, shut your mouth, shut the fuck, go to hell, burn in hell, piss off, fuck off, fuck you, screw you, get lost, drop dead, kill yourself, hang yourself, go die, eat shit, kiss my ass, crawl back, nobody asked, nobody likes you, nobody cares what, delete your account, get out of here",
    "de": "halt die fresse, halts maul, halt s maul, halt dein maul, halt die klappe, verpiss dich, fick dich, leck mich, geh sterben, fahr zur hölle, bring dich um", "fr": "ferme ta gueule, ta gueule, va te faire, nique ta, casse toi, va crever, dégage, va au diable, ferme la",
    "es": "cállate, vete al infierno, vete a la mierda, que te jodan, chinga tu, vete al diablo, muérete", "pt": "vai se ferrar, cala a boca, cale a boca, vai à merda, vai se foder, vai tomar, vai para o inferno", "sv": "håll käften, håll käft, dra åt helvete, far åt helvete, stick och brinn, gå och dö",
    "fi": "turpa kiinni, suu kiinni, painu helvettiin, haista vittu, suksi vittuun, mene helvettiin", "ru": "заткнись, иди к чёрту, иди к черту, пошёл на, пошел на, пошёл вон, пошел вон, отвали, закрой рот, иди в жопу, убей себя", "zh": "闭嘴, 滚开, 去死, 滚蛋, 给我滚, 滚出去",
}
PROFANE = {
    "en": "fuck, fucking, fucked, fucker, shit, bullshit, goddamn, motherfucking", "de": "scheiße, scheiss", "fr": "putain, merde, bordel", "es": "joder, coño, mierda", "pt": "merda, porra, caralho", "sv": "jävla, helvete", "fi": "perkele, vittu, saatana", "ru": "блять, хуй, пиздец, нахуй, ёбаный", "zh": "他妈的, 操你, 妈的",
}
#: What announces, wishes or justifies harm, and the harm.
ANNOUNCE = {
    "en": "i will, i'll, ill, i'm going to, i am going to, gonna, we will, i hope, hope you, i wish, should be, ought to be, deserve, deserves, deserved, if you, you will, you'll, you are going to, you're going to, someone should, somebody should, i want to, i swear, would be better, better off, wait until, were never, day you were",
    "de": "ich werde, wir werden, ich hoffe, hoffentlich, du wirst, sollte man, sollst, verdienst, ich wünsche, warte nur", "fr": "je vais, on va, j'espère, tu vas, tu mérites, tu devrais, je te jure, attends", "es": "voy a, vamos a, espero que, ojalá, te vas a, vas a, mereces, deberían, te juro",
    "pt": "vou, vamos, espero que, tomara que, você vai, merece, deviam, juro", "sv": "jag ska, vi ska, hoppas, du ska, du kommer, förtjänar, borde", "fi": "minä, aion, toivottavasti, tulet, ansaitset, pitäisi, saat vielä", "ru": "я тебя, мы тебя, чтоб ты, чтобы ты, надеюсь, ты ещё, ты еще, заслуживаешь, тебя надо", "zh": "我要, 我会, 希望你, 你会, 你应该, 你该, 我们要, 早晚",
}
HARM = {
    "en": "kill, killed, murder, hurt, beat, beaten, break, broken, smash, crush, cut, slit, stab, shoot, shot, hang, hanged, burn, burned, burns, choke, choked, strangle, bury, buried, punch, punched, kick, kicked, whip, whipped, flogged, rot, rots, die, dies, died, dead, suffer, bleed, drown, vanish, vanished, disappear, disappeared, gone, stopped breathing, stop breathing, falls on, crashes, hit by, regret, pay for, make you pay, come for you, find you, destroy, destroyed, cry for, miss you, shed a tear, saddest, worst, born, fingers, skull, throat, teeth, neck, cancer",
    "de": "umbringen, töten, bringe, schlage, schlagen, verprügeln, brechen, breche, sterben, stirbst, verrecken, verrecke, bereuen, fertig, finden, finde, abstechen, erschießen, büßen", "fr": "tuer, crever, crèves, mourir, meures, frapper, casser, payer, regretter, égorger, brûler, retrouver, buter", "es": "matar, muera, mueras, morir, romper, partir, golpear, pagar, arrepentir, encontrar, quemar, sufrir",
    "pt": "matar, morra, morrer, quebrar, bater, pagar, arrepender, encontrar, queimar, sofrer", "sv": "döda, döda dig, dö, dör, slå, krossa, ångra, hitta, bränna, lida", "fi": "tapan, tappaa, kuolet, kuole, hakkaan, murskaan, kadut, katumaan, löydän, kärsit", "ru": "убью, убить, убьём, сдох, сдохни, сдохнешь, умри, умрёшь, пожалеешь, найду, зарежу, сломаю, побью, прибить", "zh": "杀, 弄死, 打死, 打断, 后悔, 死, 找到你, 付出代价",
}
STALK = {"en": "know where you, know which, know what time you, watching you, watching your, follow you, outside your", "de": "weiß wo du, weiss wo du, kenne deine", "fr": "sais où tu, sais où", "es": "sé dónde, sabemos dónde", "pt": "sei onde", "sv": "vet var du", "fi": "tiedän missä", "ru": "знаю где ты, знаю где", "zh": "知道你住, 知道你在"}
PLACE = {"en": "live, lives, sleep, sleeps, work, park, home, house, street, family, kids, school", "de": "wohnst, schläfst, arbeitest, familie", "fr": "habites, dors, travailles, famille", "es": "vives, duermes, trabajas, familia", "pt": "mora, vive, dorme, família", "sv": "bor, sover, jobbar, familj", "fi": "asut, nukut, perheesi", "ru": "живёшь, живешь, спишь, семья", "zh": "住, 家"}
GROUPS = {
    "en": "foreigner, refugee, immigrant, migrant, outsider, stranger, southerner, northerner, newcomer, cripple, gypsy, gypsies, believer, unbeliever, infidel, heathen, native, minorities, peasant, jews, muslims, christians, hindus, blacks, gays, homosexuals, lesbians, transsexuals, women, asians, africans, arabs, roma, mexicans, disabled people, poor people, old people, those people, these people, that faith, this religion, their kind, your kind, that race, this race",
    "de": "ausländer, flüchtling, migrant, zuwanderer, fremde, fremden, asylanten, juden, muslime, zigeuner, schwarze, frauen, behinderte, da drüben", "fr": "étranger, réfugié, migrant, immigré, juifs, musulmans, arabes, noirs, femmes, tziganes, ces gens, gens là", "es": "extranjero, refugiado, inmigrante, migrante, forastero, judíos, musulmanes, gitanos, negros, mujeres, moros",
    "pt": "estrangeiro, refugiado, imigrante, migrante, forasteiro, judeus, muçulmanos, ciganos, negros, mulheres", "sv": "utlänning, flykting, invandrare, invandrarna, främling, judar, muslimer, romer, zigenare, kvinnor", "fi": "ulkomaalaiset, pakolaiset, maahanmuuttajat, muukalaiset, juutalaiset, muslimit, romanit, mustalaiset, naiset", "ru": "чужак, беженец, беженцы, беженцев, мигрант, приезжие, понаехавшие, иностранец, иностранцы, евреи, мусульмане, цыгане", "zh": "外地人, 难民, 外国人, 移民, 外来者, 犹太人, 穆斯林, 女人",
}
#: Words before a group that has no name here.
SUCH = {"en": "those, these, all the, them, they", "de": "diese, die da, alle, solche", "fr": "ces, tous ces, ils, eux", "es": "esos, estos, esas, todos los, ellos", "pt": "esses, estes, essas, todos os, eles", "sv": "de där, dessa, sådana, alla", "fi": "nuo, nämä, ne, kaikki", "ru": "эти, эта, они, все эти", "zh": "那些, 这些, 他们"}
DEHUMANISE = {
    "en": "vermin, rats, parasites, cockroaches, leeches, maggots, lice, locusts, subhuman, subhumans, animals, apes, savages, barbarians, scum, filth, plague, disease, infestation, inferior, less than human, born liars, liars, thieves, criminals, rapists, like dogs, like rats, like animals, like rabbits, breed like, lesser race, lesser breed, closer to apes",
    "de": "ungeziefer, ratten, parasiten, schmarotzer, gesindel, abschaum, untermenschen, dreck, pest, kakerlaken, tiere", "fr": "vermine, rats, parasites, cafards, nuisibles, racaille, déchets, animaux, sous hommes", "es": "ratas, basura, parásitos, cucarachas, plaga, escoria, animales, alimañas", "pt": "ratos, vermes, baratas, parasitas, praga, escória, animais",
    "sv": "ohyra, råttor, kackerlackor, parasiter, avskum, djur", "fi": "rottia, syöpäläisiä, loisia, torakoita, saastaa, eläimiä", "ru": "тараканы, тараканов, крысы, крыс, паразиты, нечисть, отребье, зараза, вредители, скот, животные", "zh": "害虫, 老鼠, 寄生虫, 蟑螂, 败类, 畜生",
}
EXCLUDE = {
    "en": "wiped out, wipe them out, exterminated, eradicated, driven out, kicked out, thrown out, deported, expelled, sent back, send them back, send them home, go back to, locked up, gassed, shot, hanged, purged, have to go, must go, get rid of, keep them out, keep them off, keep them away, put down, put them down, out of our, not welcome, don't belong, do not belong, let them drown, let them starve, let them die, let them freeze, let them burn, good riddance",
    "de": "vertrieben, ausgerottet, vernichtet, abgeschoben, weggesperrt, eingesperrt, vergast, müssen weg, muss weg, müssen raus, raus aus", "fr": "chasser, chassés, expulser, expulsés, éliminer, éliminés, exterminer, brûler, dehors, doivent partir", "es": "quemarlos, echarlos, expulsarlos, eliminarlos, matarlos, exterminarlos, expulsados, eliminados, exterminados, fuera de", "pt": "expulsos, eliminados, exterminados, expulsar, queimados, fora daqui",
    "sv": "utrotas, kastas ut, utvisas, fördrivas, ska bort, slängas ut", "fi": "hävittää, karkottaa, ajaa pois, tappaa, heittää ulos", "ru": "гнать, выгнать, истребить, уничтожить, давить, депортировать, вон отсюда", "zh": "赶走, 消灭, 驱逐, 赶出, 滚出, 杀光",
}
#: Weak signs of contempt, of use only beside a group.
CONTEMPT = {
    "en": "stink, stinks, smell, filthy, dirty, steal, stealing, lie, lying, lazy, cheat, invade, invading, ruin, ruined, ruining, flood, flooding, cleaner, safer, better before, decent people, normal people, all they know, by nature, by birth, never trust, never hire, just never, when they leave, should have to, lock up, stupid, ugly, hate, disgusting, crime, beaten, dogs, out or",
    "de": "stinken, klauen, lügen, faul, hassen, schmutzig, kriminell", "fr": "puent, volent, mentent, sales, voleurs, déteste", "es": "apestan, roban, mienten, sucios, ladrones, odio", "pt": "fedem, roubam, mentem, sujos, ladrões, odeio", "sv": "stinker, stjäl, ljuger, smutsiga, hatar", "fi": "haisevat, varastavat, valehtelevat, likaisia, vihaan", "ru": "воняют, воруют, врут, грязные, ненавижу", "zh": "臭, 偷, 骗, 脏, 恨",
}
EXPLICIT = {
    "en": "blowjob, handjob, orgasm, threesome, nudes, horny, panties, cum, cumming, porn, porno, masturbate, masturbating, dildo, gangbang, creampie, tits, pussy, fuck her, fuck him, fuck me, fucked her, fucked him, fucked me, touch myself, touching myself, suck my, sucked his, oral sex, anal sex, had sex, having sex, sex on, sex with, sex tape, erotic, kinky",
    "de": "gefickt, ficken, fickte, blasen, wichsen, muschi, titten, geil", "fr": "faire baiser, baisé, baisée, sucer, branler, chatte, sodomie, pipe", "es": "follar, follando, polla, mamada, tetas, correrse", "pt": "foder, fodendo, boquete, buceta, gozar", "sv": "knulla, knullade, knullad, kuk, onanera, suga av", "fi": "nussia, pillu, kyrpä, runkata, naida", "ru": "трахаться, трахать, трахал, минет, сосать, сиськи, кончил, ебать", "zh": "做爱, 性交, 口交, 鸡巴, 操她, 裸照, 高潮",
}
SUGGESTIVE = {
    "en": "naked, nude, moaning, moaned, moan, breasts, groaned, groan, stroked, stroking, sex, sexy, thighs, nipples, cock, dick, lust, seduce, undressed, strip, stripped, begged, caressed, throbbing, aroused, licking, kissed her, kissed him, her body, his body, fuck",
    "de": "nackt, brüste, stöhnte, lust", "fr": "nu, nue, seins, gémissait, désir", "es": "desnuda, desnudo, pechos, gemía", "pt": "nua, nu, seios, gemia", "sv": "naken, bröst, stönade", "fi": "alasti, rinnat, voihki", "ru": "голая, голый, стонала, грудь", "zh": "脱光, 裸体, 呻吟, 胸部",
}
SOUND = {
    "en": "screening, cancer, education, consent, reproduction, gene, plant, naked eye, star, terminal, process, processes, thread, server, database, algorithm, function, compiler, protocol, medical, doctor, patient, clinical, biology, species, cell, anatomy, therapy, statistics, census, study, research, historian, history, novel, article, law, tax, wage, surgery, diagnosis, symptom, vaccine, museum, farm, farmer, poultry, livestock, barn, veterinarian, villain, chapter",
}
INTENSE = {"en": "such a, such an, what a, what an, you are a, you are an, youre a, you're a, nothing but a, nothing but an", "de": "du bist ein, du bist eine, was für ein", "fr": "quel, tu n'es qu un, tu es un, tu es une", "es": "eres un, eres una, qué", "pt": "você é um, você é uma, que", "sv": "du är en, du är ett, vilken", "fi": "olet", "ru": "ты просто, какой же ты", "zh": "你是, 你就是"}
TALK = {"en": "the word, the term, word comes, slang, etymology, dictionary, definition, noun, verb, adjective, pronounced, spelled, translates, the phrase, my own, i was, i made, my mistake"}

_LISTS = {"insult": INSULTS, "mild": MILD, "scorn": SCORN, "address": ADDRESS, "dismissal": DISMISSAL, "profane": PROFANE, "announce": ANNOUNCE, "harm": HARM, "stalk": STALK, "place": PLACE, "group": GROUPS, "such": SUCH, "dehumanise": DEHUMANISE, "exclude": EXCLUDE, "contempt": CONTEMPT, "explicit": EXPLICIT, "suggestive": SUGGESTIVE, "sound": SOUND, "talk": TALK, "intense": INTENSE}
#: Endings by language of the single words of a list.
FORMS = {
    "en": " s es", "de": " e er es en em n s", "fr": " e s es", "es": " s es a as o os", "pt": " s es a as o os", "sv": " a t en er ar arna na n r", "fi": " t a n", "ru": " а у и ы ов ом ам ая ий ое ые ой ую", "zh": "",
}
_INFLECTED = ("insult", "mild", "scorn", "group", "explicit", "sound")
VOTERS = ("insult at someone", "mild insult at someone", "scorn with insult", "dismissal", "profanity", "threat", "stalking", "group dehumanised", "group excluded", "group held in contempt", "dehumanised and excluded", "such people", "explicit", "suggestive", "disguised", "sound matter", "no such word", "group alone", "nobody addressed", "talk of a word")
#: The first voter that says sound; those before say abusive.
_SOUND_FROM = VOTERS.index("sound matter")
_LOWEST = 1 << 18
_END = np.zeros(0x110000, bool)
_END[[ord(c) for c in ".!?;\n。！？；…"]] = True
#: Endings that make a plural the name of a people.
_PEOPLES = ("ites", "ians", "erners", "landers", "eans")


def _phrases(lists: dict[str, str], inflected: bool) -> list[str]:
    out = []
    for lang, text in lists.items():
        for p in (" ".join(x.split()) for x in text.split(",")):
            out.append(p)
            if inflected and " " not in p:
                stem = p[:-1] if lang in ("es", "pt") and p[-1] in "ao" else p
                out += [stem + e for e in FORMS[lang].split()]
    return sorted(set(out))


@lru_cache(1)
def _lexicon() -> tuple[tuple[np.ndarray, np.ndarray], ...]:
    """For phrases of one to four words: sorted hashes and the lists of each as bits."""
    bits: dict[int, dict[int, int]] = {n: {} for n in (1, 2, 3, 4)}
    phrases = [(p, k) for k, (name, l) in enumerate(_LISTS.items()) for p in _phrases(l, name in _INFLECTED)]
    w = textvec.Words([p for p, _ in phrases])
    counts = np.bincount(w.doc, minlength=len(phrases))
    first = np.concatenate(([0], np.cumsum(counts)))
    for i, (_, k) in enumerate(phrases):
        h = w.h[first[i] : first[i + 1]]
        if 1 <= len(h) <= 4:
            g = int(textvec.grams(h, len(h))[0])
            bits[len(h)][g] = bits[len(h)].get(g, 0) | 1 << k
    out = []
    for n in (1, 2, 3, 4):
        keys = np.array(sorted(bits[n]), np.uint64)
        out.append((keys, np.array([bits[n][int(x)] for x in keys], np.int32)))
    return tuple(out)


@lru_cache(1)
def _disguised() -> tuple[dict[str, str], dict[tuple[str, str, int], list[str]]]:
    """What a word may stand for: by its letters alone, and by first letter, last letter and length."""
    words = [p for l in (INSULTS, MILD, SCORN, PROFANE, EXPLICIT) for p in _phrases({"en": l["en"]}, True) if p.isascii() and len(p) > 2]
    words += ["naked", "sex", "cock", "nude"]
    plain = {p.replace(" ", ""): p for p in words}
    shape: dict[tuple[str, str, int], list[str]] = {}
    for p in words:
        shape.setdefault((p[0], p[-1], len(p)), []).append(p)
    return plain, shape


_LEET = str.maketrans("0134578@$!|", "oieastbasil")
_LEET_L = str.maketrans("0134578@$!|", "oleastbasll")
_TOKEN = re.compile(r"(?<!\w)\w(?:[ ._-]{1,4}\w(?!\w)){2,}(?:[ ._-]{1,4}\w{1,2}(?!\w))?|[\w@$*!|]+(?: [0-9@$*][\w@$*!|]*)*")


def undisguise(sentence: str) -> str | None:
    """The sentence with the disguised words of the lexicons written out; null where there is none."""
    plain, shape = _disguised()
    found = False

    def read(m: re.Match[str]) -> str:
        nonlocal found
        t = m[0].lower().rstrip("!|.")
        word = None
        if re.fullmatch(r"\w(?:[ ._-]+\w)+\w?", t):
            letters = re.sub(r"[ ._-]", "", t)
            word = plain.get(letters) or plain.get(letters[1:]) or plain.get(letters.removesuffix("s")) or plain.get(letters[1:].removesuffix("s"))
        elif "*" in t and t.count("*") < len(t):
            for w in shape.get((t[0], t[-1], len(t)), ()) or shape.get((t[0], t[-2] if len(t) > 2 else "", len(t) - 1), ()):
                if all(a == b or a == "*" for a, b in zip(t, w, strict=False)):
                    word = w
                    break
        elif any(c in "0134578@$!|" for c in t) and any(c.isalpha() or c in "@$" for c in t):
            for table in (_LEET, _LEET_L):
                word = word or plain.get(re.sub(" ", "", t.translate(table))) or plain.get(re.sub(" ", "", t.translate(table)).removesuffix("s"))
        if word is None and (r := re.sub(r"(.)\1{2,}", r"\1", t)) != t:
            word = plain.get(r) or plain.get(r.removesuffix("s")) or plain.get(r + "s") or plain.get(re.sub(r"(.)\1{2,}", r"\1\1", t))
        if word is None and " " in t and not re.fullmatch(r"\w(?:[ ._-]+\w)+\w?", t):
            return re.sub(r"\S+", lambda x: read(x), m[0])
        if word is None:
            return m[0]
        found = True
        return f" {word} xdisguisedx "

    out = _TOKEN.sub(read, sentence)
    return out if found else None


@dataclass
class Sentences:
    """The sentences of a chunk: document of each, votes, and the hashed words and word pairs of all of them."""

    doc: np.ndarray
    votes: np.ndarray
    first: np.ndarray
    feature: np.ndarray  # (2, words): the word's and the pair's place among the weights
    place: np.ndarray  # (sentences, 2): start and end in the text
    flagged: np.ndarray


def _analyse(texts: Sequence[str]) -> Sentences | None:
    w = textvec.Words([t.lower() for t in texts])
    total = len(w.h)
    if not total:
        return None
    ends = np.concatenate(([0], np.cumsum(_END[w.codes])))
    new = np.concatenate(([True], (ends[w.start[1:]] > ends[w.end[:-1]]) | (w.doc[1:] != w.doc[:-1])))
    # A dot between single letters is no end.
    single = w.end - w.start == 1
    close = np.concatenate(([False], w.start[1:] - w.end[:-1] <= 4))
    small = w.end - w.start <= 2
    new &= ~(close & small & np.concatenate(([False], single[:-1])) & (w.cls[w.start] == 1)) | np.concatenate(([True], w.doc[1:] != w.doc[:-1]))
    first = np.flatnonzero(new)
    n = len(first)
    sent = np.cumsum(new) - 1
    last = np.append(first[1:], total)
    marks = np.zeros(total, np.int32)
    for size, (keys, bits) in enumerate(_lexicon(), 1):
        g = textvec.grams(w.h, size)
        if not len(g):
            continue
        k = np.searchsorted(keys, g)
        k[k == len(keys)] = 0
        hit = np.flatnonzero((keys[k] == g) & (sent[: len(g)] == sent[size - 1 :]))
        marks[hit] |= bits[k[hit]]
    at = {name: (marks >> k & 1).astype(bool) for k, name in enumerate(_LISTS)}
    at["group"] |= _named_people(w)
    hidden_word = w.h == _hash("xdisguisedx")
    some = lambda mask: np.bincount(sent[mask], minlength=n) > 0
    has = {name: some(mask) for name, mask in at.items()}
    hidden = some(hidden_word)
    count = np.cumsum

    def near(a: np.ndarray, b: np.ndarray, reach: int) -> np.ndarray:
        """Sentences with a word of b within ``reach`` words of one of a."""
        i = np.flatnonzero(b)
        sums = np.concatenate(([0], count(a)))
        lo, hi = np.maximum(i - reach, first[sent[i]]), np.minimum(i + reach + 1, last[sent[i]])
        return np.bincount(sent[i[sums[hi] - sums[lo] > 0]], minlength=n) > 0

    insult = at["insult"] | at["mild"]
    short = last - first <= 9
    v = np.zeros((n, len(VOTERS)), np.int8)
    v[:, 0] = near(at["address"], at["insult"], 6)
    v[:, 1] = near(at["address"], at["mild"], 4) & (short | has["scorn"] | has["intense"] | hidden)
    v[:, 2] = near(at["scorn"], insult & ~at["scorn"], 2)
    v[:, 3] = has["dismissal"]
    v[:, 4] = has["profane"]
    v[:, 5] = has["announce"] & near(at["address"], at["harm"] & ~at["address"], 6)
    v[:, 6] = near(at["stalk"], at["place"], 6)
    v[:, 7] = has["group"] & has["dehumanise"]
    v[:, 8] = has["group"] & has["exclude"]
    v[:, 9] = has["group"] & has["contempt"]
    v[:, 10] = near(at["dehumanise"], at["exclude"], 12)
    v[:, 11] = near(at["such"], at["dehumanise"] | at["exclude"], 6)
    v[:, 12] = has["explicit"]
    v[:, 13] = np.bincount(sent[at["suggestive"]], minlength=n) > 1
    v[:, 14] = hidden
    any_bad = (v[:, :_SOUND_FROM] > 0).any(1) | has["insult"] | has["scorn"] | has["group"] | has["suggestive"] | has["dehumanise"]
    v[:, 15] = -(has["sound"] & any_bad).astype(np.int8)
    v[:, 16] = -(~any_bad).astype(np.int8)
    v[:, 17] = -(has["group"] & ~(has["dehumanise"] | has["exclude"] | has["contempt"] | has["dismissal"] | has["insult"])).astype(np.int8)
    v[:, 18] = -((has["insult"] | has["mild"] | has["scorn"]) & ~has["address"] & ~has["dismissal"] & ~hidden & (v[:, 2] == 0)).astype(np.int8)
    v[:, 19] = -(has["talk"] & any_bad & ~has["address"]).astype(np.int8)
    pair = np.concatenate(([np.uint64(0)], w.h[:-1])) * np.uint64(3) + w.h
    pair[new] = w.h[new]
    feature = np.stack([w.h >> np.uint64(46), textvec.mix(pair) >> np.uint64(46)]).astype(np.int64)
    # Sentences with signs that a disguise would leave.
    codes, cls = w.codes, w.cls
    letter, digit = cls == 1, cls == 3
    sign = (codes == 64) | (codes == 36) | (codes == 42)
    nxt = lambda a: np.concatenate((a[1:], [False]))
    odd = (letter & nxt(digit | sign)) | ((digit | sign) & nxt(letter))
    odd[:-2] |= letter[:-2] & (codes[:-2] == codes[1:-1]) & (codes[:-2] == codes[2:])
    row = np.zeros(total, bool)
    row[:-2] = single[:-2] & single[1:-1] & small[2:] & close[1:-1] & close[2:] & letter[w.start[:-2]]
    start = w.start[first]
    stop = np.append(start[1:], len(codes))
    odd_sum = np.concatenate(([0], np.cumsum(odd)))
    flagged = (odd_sum[stop] - odd_sum[np.maximum(start - 2, 0)] > 0) | (np.bincount(sent[row], minlength=n) > 0)
    doc = w.doc[first]
    return Sentences(doc, v, first, feature, np.stack([start - w.offsets[doc], np.minimum(stop - w.offsets[doc], w.offsets[doc + 1] - w.offsets[doc])], 1), flagged)


def _named_people(w: textvec.Words) -> np.ndarray:
    """Words of seven letters or more with an ending of _PEOPLES."""
    out = np.zeros(len(w.h), bool)
    long = w.end - w.start >= 7
    for e in _PEOPLES:
        ok = long.copy()
        for j, c in enumerate(reversed(e), 1):
            ok[ok] = w.codes[w.end[ok] - j] == ord(c)
        out |= ok
    return out


@lru_cache(8)
def _hash(word: str) -> np.uint64:
    return textvec.Words([word]).h[0]


def analyse(texts: Sequence[str]) -> list[Sentences]:
    """The sentences of the texts, and those of the sentences with disguised words written out, for the same documents."""
    s = _analyse(texts)
    if s is None:
        return []
    docs, plain = [], []
    for k in np.flatnonzero(s.flagged).tolist():
        d = int(s.doc[k])
        lo = max(0, int(s.place[k, 0]) - 2)
        if (u := undisguise(texts[d][lo : s.place[k, 1]])) is not None:
            docs.append(d)
            plain.append(u.replace("\n", " "))
    if not plain:
        return [s]
    extra = _analyse(plain)
    extra.doc = np.array(docs)[extra.doc]
    return [s, extra]


@dataclass(frozen=True)
class LabelModel:
    """P(vote | label) of every voter, the prior, and how far voters for the same label agree beyond what the label explains.

    Where such voters speak together, each counts for less: by 1 over 1 plus its correlations with the others that speak.
    """

    prior: float
    table: np.ndarray  # (voter, label, vote + 1)
    correlation: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        logit = np.full(len(votes), np.log(self.prior) - np.log1p(-self.prior))
        discount = 1 / (1 + (votes != 0) @ self.correlation)
        for j in range(votes.shape[1]):
            t = np.log(self.table[j, 1]) - np.log(self.table[j, 0])
            t[1] = 0.0  # a voter that says nothing counts for nothing
            logit += discount[:, j] * t[votes[:, j] + 1]
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_label_model(votes: np.ndarray, weights: np.ndarray | None = None, rounds: int = 25, prior: float = 0.02) -> LabelModel:
    """Expectation-maximisation from a majority vote; correlations from what the labels leave unexplained. ``weights``: how
    often each row of votes occurs."""
    n, k = votes.shape
    c = np.ones(n) if weights is None else weights.astype(float)
    p = np.where((votes == 1).sum(1) > (votes == -1).sum(1), 0.9, 0.01) if n else np.zeros(0)
    corr = np.zeros((k, k))
    one_hot = np.stack([votes == x for x in (-1, 0, 1)], 2).astype(float)
    model = LabelModel(prior, np.full((k, 2, 3), 1 / 3), corr)
    spoken = (votes != 0).any(0)
    for r in range(rounds if n else 0):
        table = np.empty((k, 2, 3))
        for y, q in ((0, (1 - p) * c), (1, p * c)):
            before = np.array([0.3, 1, 0.3]) + (np.array([0, 0, 1.0]) if y else np.array([1.0, 0, 0])) * (np.sign(votes.sum(0)) == 2 * y - 1)[:, None]
            table[:, y] = (np.einsum("n,nkv->kv", q, one_hot) + before) / (q.sum() + before.sum(1, keepdims=True))
        # A voter is kept on its own side: better than chance for what it says.
        for j in np.flatnonzero(spoken).tolist():
            for side, (yes, no) in ((2, (1, 0)), (0, (0, 1))):
                table[j, yes, side] = max(table[j, yes, side], 3 * table[j, no, side] if (votes[:, j] == side - 1).any() else table[j, no, side])
        table /= table.sum(2, keepdims=True)
        if r >= 3:
            rest = np.zeros((n, k))
            for j in range(k):
                mean = table[j] @ np.array([-1.0, 0, 1])
                rest[:, j] = votes[:, j] - ((1 - p) * mean[0] + p * mean[1])
            sd = np.sqrt(c @ rest**2 / c.sum()) + 1e-6
            corr = ((rest * c[:, None]).T @ rest) / c.sum() / np.outer(sd, sd)
            # Only voters for the same label can count the same evidence twice.
            side = np.sign(c @ votes)
            alike = (side[:, None] == side[None, :]) & ~np.eye(k, dtype=bool)
            corr = np.clip(np.where(alike, corr, 0) - 0.1, 0, None)
        model = LabelModel(float(np.clip((p * c).sum() / c.sum(), 1e-3, 0.3)), table, corr)
        p = model.posterior(votes)
    return model


@dataclass(frozen=True)
class Classifier:
    words: np.ndarray
    votes: np.ndarray
    bias: float

    def score(self, s: Sentences) -> np.ndarray:
        z = np.add.reduceat(self.words[s.feature].sum(0), s.first)
        n = np.diff(np.append(s.first, s.feature.shape[1]))
        z = z / np.sqrt(n) + s.votes @ self.votes + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_classifier(parts: list[Sentences], labels: np.ndarray, rounds: int = 150, rate: float = 0.5, ridge: float = 1.0) -> Classifier:
    """Logistic regression by full-batch Adagrad on soft labels, either class weighted alike."""
    if not parts:
        return Classifier(np.zeros(_LOWEST, np.float32), np.zeros(len(VOTERS), np.float32), -30.0)
    votes = np.concatenate([s.votes for s in parts]).astype(float)
    n = np.concatenate([np.diff(np.append(s.first, s.feature.shape[1])) for s in parts])
    places, inverse = np.unique(np.concatenate([s.feature for s in parts], 1), return_inverse=True)
    inverse = inverse.reshape(2, -1)
    first = np.concatenate(([0], np.cumsum(n)[:-1]))
    row = np.repeat(np.arange(len(n)), n)
    # Votes start from the belief that voters are right, so that one the sample hardly heard still counts.
    w, u, b = np.zeros(len(places)), np.where(np.arange(votes.shape[1]) < _SOUND_FROM, 3.0, 0.75), -2.0
    gw, gu, gb = np.full(len(places), 1e-6), np.full(len(u), 1e-6), 1e-6
    pos = max(labels.sum(), 1e-3)
    weight = labels * (len(labels) / (2 * pos)) ** 0.5 + (1 - labels)
    for _ in range(rounds):
        z = np.add.reduceat(w[inverse].sum(0), first) / np.sqrt(n) + votes @ u + b
        e = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / len(labels)
        es = (e / np.sqrt(n))[row]
        d = np.bincount(inverse[0], es, len(places)) + np.bincount(inverse[1], es, len(places)) + ridge * w / len(labels)
        du, db = votes.T @ e, e.sum()
        gw += d * d
        gu += du * du
        gb += db * db
        w -= rate * 0.2 * d / np.sqrt(gw)
        u -= rate * du / np.sqrt(gu)
        b -= rate * db / np.sqrt(gb)
    dense = np.zeros(_LOWEST, np.float32)
    dense[places] = w
    return Classifier(dense, u.astype(np.float32), float(b))


def _bits(votes: np.ndarray) -> np.ndarray:
    """The votes of each sentence as bits; a voter always says the same, so a bit tells that it spoke."""
    return (votes != 0).astype(np.int64) @ (np.int64(1) << np.arange(votes.shape[1], dtype=np.int64))


def _votes(bits: np.ndarray) -> np.ndarray:
    spoke = (bits[:, None] >> np.arange(len(VOTERS)) & 1).astype(np.int8)
    spoke[:, _SOUND_FROM:] *= -1
    return spoke


def _without_votes(s: Sentences) -> Sentences:
    return Sentences(s.doc, np.zeros_like(s.votes), s.first, s.feature, s.place, s.flagged)


def fit_on_sentences(model: LabelModel, sentences: Sequence[str]) -> Classifier:
    """The classifier fitted to the label model's posteriors; voted sentences are shown with and without their votes."""
    parts, labels = [], []
    for lo, hi in textvec.chunks(sentences):
        for s in analyse(sentences[lo:hi]):
            q = model.posterior(s.votes)
            parts += [s, _without_votes(s)]
            labels += [q, q]
    return fit_classifier(parts, np.concatenate(labels) if labels else np.zeros(0))


def fit(texts: Sequence[str], seed: int = 42) -> tuple[LabelModel, Classifier]:
    """Label model and classifier from unlabelled texts."""
    parts = [s for lo, hi in textvec.chunks(texts) for s in analyse(texts[lo:hi])]
    if not parts:
        return fit_label_model(np.zeros((0, len(VOTERS)), np.int8)), fit_classifier([], np.zeros(0))
    patterns, counts = np.unique(np.concatenate([_bits(s.votes) for s in parts]), return_counts=True)
    model = fit_label_model(_votes(patterns), counts)
    drawn = _draw(pd.concat([_sentences(texts, range(len(texts)), seed)], ignore_index=True), 1 << 30)
    return model, fit_on_sentences(model, drawn)


def _sentences(texts: Sequence[str], docs: Sequence[int], seed: int) -> pd.DataFrame:
    """(voted, order, sentence) of the texts: all sentences that some voter calls abusive, and two more of each text."""
    rows: list[tuple[bool, int, str]] = []
    docs = list(docs)
    for lo, hi in textvec.chunks([texts[d] for d in docs]):
        part = [texts[d] for d in docs[lo:hi]]
        for s in analyse(part)[:1]:
            h = s.feature.sum(0)
            order = textvec.mix(np.add.reduceat(h.astype(np.uint64), s.first) + np.uint64(seed)) >> np.uint64(1)
            bad = (s.votes[:, :_SOUND_FROM] > 0).any(1) | s.flagged
            n = np.bincount(s.doc, minlength=len(part))
            start = np.cumsum(n) - n
            pick = np.zeros(len(bad), bool)
            for j in (np.uint64(0), np.uint64(20)):
                k = np.flatnonzero(n)
                pick[start[k] + ((order[start[k]] >> j) % n[k].astype(np.uint64)).astype(np.int64)] = True
            for i in np.flatnonzero(bad | pick).tolist():
                t = part[s.doc[i]]
                rows.append((bool(bad[i]), int(order[i]), t[max(0, int(s.place[i, 0]) - 2) : int(s.place[i, 1])]))
    return pd.DataFrame(rows, columns=["voted", "ord", "sentence"])


def _draw(rows: pd.DataFrame, fit_sentences: int) -> list[str]:
    rows = rows.drop_duplicates().sort_values(["ord", "sentence"])
    bad = rows[rows["voted"]]["sentence"].tolist()[:fit_sentences]
    return bad + rows[~rows["voted"]]["sentence"].tolist()[: 2 * fit_sentences]


def train(rows: DataFrame, *, pool_rows: int, fit_sentences: int, seed: int) -> tuple[LabelModel, Classifier]:
    """Label model and classifier from rows (id, text): one pass over all of them."""
    total = rows.count()
    if not total:
        return fit([], seed)
    limit = 1.2 * pool_rows / total + 5 * (pool_rows**0.5) / total
    in_pool = F.lit(True) if limit >= 1 else F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1 << 31)) < int(limit * (1 << 31))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, int] = {}
        for b in batches:
            texts = b["text"].tolist()
            for lo, hi in textvec.chunks(texts):
                for s in analyse(texts[lo:hi]):
                    for p, c in zip(*(x.tolist() for x in np.unique(_bits(s.votes), return_counts=True)), strict=True):
                        counts[p] = counts.get(p, 0) + c
            pool = np.flatnonzero(b["pooled"].to_numpy())
            if len(pool):
                rows_of = _sentences(texts, pool.tolist(), seed)
                yield pd.DataFrame({"pattern": np.where(rows_of["voted"], -1, -2), "n": rows_of["ord"], "sentence": rows_of["sentence"]})
        yield pd.DataFrame({"pattern": list(counts), "n": list(counts.values()), "sentence": None})

    seen = stored(rows.withColumn("pooled", in_pool).mapInPandas(scan, "pattern long, n long, sentence string"))
    patterns = seen.where("pattern >= 0").groupBy("pattern").agg(F.sum("n").alias("n")).toPandas()
    model = fit_label_model(_votes(patterns["pattern"].to_numpy(np.int64)), patterns["n"].to_numpy())
    parts = []
    for kind, most in ((-1, fit_sentences), (-2, 2 * fit_sentences)):
        kept = seen.where(F.col("pattern") == kind).select("n", "sentence").distinct()
        # The order is a hash of 63 bits, so a threshold keeps about as many rows as are wanted, however many tasks there are.
        least = (1.2 * most + 5 * most**0.5) / max(kept.count(), 1)
        p = kept.where(F.col("n") <= min((1 << 63) - 1, int(least * (1 << 63)))).orderBy("n", "sentence").limit(most).toPandas()
        parts.append(pd.DataFrame({"voted": kind == -1, "ord": p["n"], "sentence": p["sentence"]}))
    return model, fit_on_sentences(model, _draw(pd.concat(parts, ignore_index=True), fit_sentences))


def abuse_scores(docs: DataFrame, id_col: str, text_col: str, *, pool_rows: int = 60_000, fit_sentences: int = 4000, seed: int = 42) -> DataFrame:
    """(id, score): near 1 for texts with abusive, hateful or sexually explicit language."""
    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    _, classifier = train(rows, pool_rows=pool_rows, fit_sentences=fit_sentences, seed=seed)
    id_type = rows.schema["id"].dataType.simpleString()
    sent = rows.sparkSession.sparkContext.broadcast(classifier)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = sent.value
        for b in batches:
            texts = b["text"].tolist()
            out = np.zeros(len(texts))
            for lo, hi in textvec.chunks(texts):
                for s in analyse(texts[lo:hi]):
                    np.maximum.at(out, lo + s.doc, c.score(s))
            yield pd.DataFrame({"id": b["id"], "score": out})

    return rows.mapInPandas(score, f"id {id_type}, score double").groupBy("id").agg(F.max("score").alias("score")).withColumnRenamed("id", id_col)


def abusive(docs: DataFrame, id_col: str, text_col: str, *, least_score: float = 0.5, **options: object) -> DataFrame:
    return abuse_scores(docs, id_col, text_col, **options).where(F.col("score") >= least_score).select(id_col)


def rates(docs: DataFrame, id_col: str, text_col: str, source_col: str, *, least_score: float = 0.5, **options: object) -> DataFrame:
    """(source, documents, abusive, rate) of every source."""
    s = abuse_scores(docs, id_col, text_col, **options)
    source = docs.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.min(source_col).alias("source"))
    flag = (F.col("score") >= least_score).cast("long")
    return source.join(s, id_col).groupBy("source").agg(F.count("*").alias("n_documents"), F.sum(flag).alias("n_abusive"), F.avg(flag.cast("double")).alias("rate"))
