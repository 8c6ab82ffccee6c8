"""Leak search with ids of text, tiny items, and blocks."""

from siltworks.llm import leak


def test_item_ids_may_be_text_and_blocks_change_nothing(spark):
    q = "which river of the northern province carries the most water in the spring season of a wet year"
    items = [("it-a", q), ("it-b", "photosynthesis"), ("it-c", None), (None, q), ("it-d", "name the oldest bridge over the lower canal near the mill")]
    df = spark.createDataFrame(items, "item_id string, question string")
    texts = [("p1", f"Please say: {q.title()}?"), ("p2", "What is Photosynthesis"), ("p3", "nothing here"), ("p4", "<b>name</b> the oldest bridge over the lower canal, near the mill!"), (None, q), ("p5", None)]
    corpus = spark.createDataFrame(texts, "prompt_id string, prompt string")
    got = [sorted(tuple(r)[:2] for r in leak.leaked(corpus, "prompt_id", "prompt", df, "item_id", "question", block_items=b).collect()) for b in (1, 2, 5000)]
    assert got[0] == got[1] == got[2] == [("p1", "it-a"), ("p2", "it-b"), ("p4", "it-d")]


def test_a_tiny_pattern_does_not_shorten_the_shifts_of_the_others():
    patterns = {b" x ": [(0, 0)], b" the amber valve ": [(1, 0)], b" of the old mill ": [(2, 0)]}
    s = leak.Search(patterns)
    assert max(x.shift.max() for x in s.searchers) >= 14
    pos, pattern = s.find(b" turn the amber valve x of the old mill ")
    names = list(patterns)
    assert sorted((p, names[i]) for p, i in zip(pos.tolist(), pattern.tolist(), strict=True)) == [(5, names[1]), (21, names[0]), (23, names[2])]


def test_common_words_of_many_pairs_in_step(monkeypatch):
    import random

    import numpy as np

    rng = random.Random(2)
    items = [[f"w{rng.randrange(12)}" for _ in range(rng.choice([3, 14, 40, 62, 63, 90]))] for _ in range(40)]
    texts = [[f"w{rng.randrange(16)}" for _ in range(rng.randrange(0, 120))] for _ in range(20)]
    text, item = np.array([rng.randrange(20) for _ in range(300)]), np.array([rng.randrange(40) for _ in range(300)])
    lo = np.array([rng.randrange(30) for _ in range(300)])
    hi = lo + np.array([rng.randrange(100) for _ in range(300)])
    want = [leak.common_words(len(items[i]), leak.word_places(items[i]), texts[t][x:y]) for t, i, x, y in zip(text, item, lo, hi)]
    for size in (1 << 26, 8 * 16 * 3):
        monkeypatch.setattr(leak, "TABLE_BYTES", size)
        assert leak.Vocabulary(items).common(texts, text, item, lo, hi).tolist() == want
    most = leak.Vocabulary(items).most(texts, text, item)
    assert most.tolist() == [sum(w in set(texts[t]) for w in items[i]) for t, i in zip(text, item)] and all(m >= w for m, w in zip(most, want))


def test_only_items_with_a_dense_run_are_aligned(monkeypatch):
    import pandas as pd

    item = [f"w{i}" for i in range(40)]
    # Many runs and common words, but of no half of the item three quarters: no passage of it can be accepted.
    scattered, half = " ".join(item[:9] + ["and"] + item[30:39]), " ".join(item[10:18] + ["changed"] + item[19:31])
    aligned, passage = [], leak.passage
    monkeypatch.setattr(leak, "passage", lambda a, b: aligned.append(b) or passage(a, b))
    texts = pd.DataFrame({"id": ["scattered", "half"], "text": [scattered, half]})
    found = pd.concat(leak._search([item], [7], 3, 3, 12)(iter([texts])))
    assert found[["id", "item"]].values.tolist() == [["half", 7]]
    assert len(aligned) == 1


def test_dense_holds_for_every_accepted_passage(monkeypatch):
    import random

    import numpy as np

    rng = random.Random(3)
    items = [[f"w{rng.randrange(30)}" for _ in range(rng.choice([1, 3, 4, 9, 12, 13, 30, 63, 80]))] for _ in range(60)]
    texts = [[f"w{rng.randrange(60)}" for _ in range(rng.randrange(0, 40))] for _ in range(30)]
    for i in range(30):
        a, n = rng.randrange(0, len(items[i]) // 2 + 1), len(items[i])
        texts[i] += [w if rng.random() < 0.85 else "other" for w in items[i][a : a + rng.randrange(n // 2, n + 1)]]
    text, item = (x.ravel() for x in np.meshgrid(np.arange(len(texts)), np.arange(len(items))))

    def dense(i: list[str], t: set[str]) -> bool:
        runs = ((x, y) for x in range(len(i)) for y in range(x + 1, len(i) + 1) if 2 * (y - x) >= len(i))
        return any(4 * sum(w in t for w in i[x:y]) >= 3 * (y - x) for x, y in runs)

    want = [dense(items[i], set(texts[d])) for d, i in zip(text, item)]
    accepted = [leak.leaks(len(items[i]), *leak.passage(items[i], texts[d]), 12) for d, i in zip(text, item)]
    assert any(accepted) and all(w for w, a in zip(want, accepted) if a) and not all(want)
    v = leak.Vocabulary(items)
    for size in (1 << 18, 100):
        monkeypatch.setattr(leak, "PAIR_WORDS", size)
        assert v.dense(v.there(texts, text), text, item).tolist() == want


def test_folding_by_character_is_folding_of_the_text():
    import unicodedata

    for c in [chr(i) for i in range(0x80, 0x30000) if not 0xD800 <= i < 0xE000]:
        t = unicodedata.normalize("NFKD", f"aΣ{c}b Σ")
        t = "".join(x for x in t if unicodedata.category(x) not in ("Mn", "Cf", "Me"))
        assert leak.normal_words(f"aΣ{c}b Σ") == leak._WORD.findall(t.casefold().translate(leak._LOOKALIKE).lower())
