import numpy as np
import pytest
from pyspark.sql import functions as F

from siltworks.llm import mixing, packing, quota, reservoir, tokens

ROWS = "prompt_id string, rec_no long, shard string"


def pool(spark, n=400, extra=False):
    rows = [(f"p{i % n}", i, f"s{i // 130:02d}") for i in range(n + n // 4)] + [(None, 9999, "s00"), ("p1", None, None)]
    df = spark.createDataFrame(rows, ROWS)
    return df.withColumns({"id": F.lit(1), "batch": F.lit("x"), "slot": F.lit(2), "at": F.lit(0)}) if extra else df


def sample(df, k, seed=1, **o):
    return [r[0] for r in reservoir.reservoir_sample(df, "prompt_id", "rec_no", "shard", k=k, seed=seed, slots=4, **o).collect()]


def test_reservoir_has_k_distinct_known_ids(spark):
    s = sample(pool(spark, extra=True), 50)
    assert len(s) == len(set(s)) == 50 and all(x.startswith("p") for x in s)
    assert sorted(s) == sorted(sample(pool(spark).repartition(7), 50))


def test_reservoir_of_few_and_no_rows(spark):
    assert len(sample(pool(spark, 30), 1000)) == 30
    assert sample(pool(spark).limit(0), 10) == []
    assert len(sample(pool(spark), 50, max_batches=2)) == 50


def test_reservoir_plan_is_uniform_over_batches():
    # The slots' draws, without Spark: every id of every batch must be held equally often.
    hits, rounds, k = np.zeros(60), 3000, 15
    for r in range(rounds):
        plan = reservoir.Plan(k, 3, r)
        sizes = [20, 25, 15]
        ids = np.split(np.arange(60), np.cumsum(sizes)[:-1])
        per_slot = {s: ([], [], {}) for s in range(3)}
        for b, x in enumerate(ids):
            plan.arrive(b, np.bincount(x % 3, minlength=3))
            ins, out = plan.steps[-1]
            rng = np.random.default_rng([7, r, b])
            for s in range(3):
                mine = rng.permutation(x[x % 3 == s])[: ins[s]]
                per_slot[s][0].extend([b] * len(mine))
                per_slot[s][1].extend(mine.tolist())
                per_slot[s][2][b] = int(out[s])
        held = []
        for s, (bs, xs, ev) in per_slot.items():
            xs = np.array(xs, np.int64)
            held += xs[reservoir.replay(s, r, np.array(bs), xs, ev)].tolist()
        assert len(held) == k
        hits[held] += 1
    expected = rounds * k / 60
    chi = ((hits - expected) ** 2 / expected).sum() / (1 - k / 60)
    assert chi < 100  # 59 degrees of freedom: the 0.999 quantile is 98


def test_reservoir_stream_keeps_the_sample(spark, tmp_path):
    st = reservoir.ReservoirStream(spark, str(tmp_path), 20, seed=3)
    seen = set()
    for b in range(4):
        ids = [f"x{i}" for i in range(b * 15, b * 15 + 20)]
        seen |= set(ids)
        st.update(spark.createDataFrame([(i,) for i in ids], "id string"), b)
        st.update(spark.createDataFrame([(i,) for i in ids], "id string"), b)
        held = [r[0] for r in st.sample().collect()]
        assert len(held) == len(set(held)) == min(20, len(seen)) and set(held) <= seen


TARGETS = [("math", "easy", 0.5, 2), ("code", "hard", 0.3, 5), ("art", "easy", 0.2, 1)]


def labelled(spark):
    rows = [(f"a{i}", " Math ", "EASY") for i in range(60)] + [(f"b{i}", "code", "hard") for i in range(3)] + [(f"c{i}", None, "easy") for i in range(10)] + [("a1", " Math ", "EASY"), (None, "math", "easy")]
    return spark.createDataFrame(rows, "prompt_id string, domain string, difficulty string").withColumns({"cell": F.lit("x"), "n": F.lit(1), "priority": F.lit(0)})


def targets(spark):
    return spark.createDataFrame(TARGETS, "domain string, difficulty string, target_share double, min_rows int").withColumns({"available": F.lit(7), "n": F.lit(9), "quota": F.lit(1)})


def test_quota_sample_counts_and_report(spark):
    s, report = quota.quota_sample(labelled(spark), "prompt_id", ("domain", "difficulty"), targets(spark))
    rows = {(r["domain"], r["difficulty"]): r for r in report.collect()}
    n = 73 // 4
    assert rows["math", "easy"]["available"] == 60 and rows["math", "easy"]["taken"] == 9
    assert rows["code", "hard"]["taken"] == 3 and rows["code", "hard"]["exhausted"]
    assert rows["art", "easy"]["available"] == 0 and rows["art", "easy"]["exhausted"] and abs(rows["art", "easy"]["wanted"] - 0.2 * n) < 1e-9
    got = s.collect()
    assert len(got) == 12 and len({r["prompt_id"] for r in got}) == 12
    again = quota.quota_sample(labelled(spark).repartition(5), "prompt_id", ("domain", "difficulty"), targets(spark))[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))


def test_quota_empty(spark):
    s, report = quota.quota_sample(labelled(spark).limit(0), "prompt_id", ("domain", "difficulty"), targets(spark))
    assert s.count() == 0 and report.where("exhausted").count() == 3
    assert quota.quota_sample(labelled(spark), "prompt_id", ("domain", "difficulty"), targets(spark).limit(0))[1].count() == 0


def test_pack_fits_and_fills():
    rng = np.random.default_rng(1)
    for capacity in (64, 500, 4096):
        sizes = np.minimum(rng.lognormal(4.5, 1, 3000).astype(int) + 1, capacity)
        bins = packing.pack(sizes, capacity)
        load = np.bincount(bins, sizes)
        assert (bins >= 0).all() and load.max() <= capacity and (load > 0).all()
        assert sizes.sum() / (len(load) * capacity) > 0.9
    assert packing.pack(np.array([5]), 5).tolist() == [0]
    assert len(set(packing.pack(np.full(10, 3), 5).tolist())) == 10


def test_pack_containers(spark):
    items = spark.createDataFrame([(i, s) for i, s in enumerate([10, 250, 40, 100, 0, 60, None, 100])] + [(3, 100), (None, 5)], "doc_id long, size int").withColumns({"id": F.lit(1), "plan": F.lit("q"), "slot": F.lit(0)})
    plans = spark.createDataFrame([("small", 100), ("bad", 0), ("large", 1000)], "plan_name string, capacity int").withColumn("tokens", F.lit(1))
    out = packing.pack_containers(items, "doc_id", "size", plans, "plan_name", "capacity", slot_items=1000)
    rows = out.collect()
    small = [r for r in rows if r["plan_name"] == "small"]
    assert sum(r["tokens"] for r in small) == sum(r["tokens"] for r in rows if r["plan_name"] == "large") == 560
    assert sorted(r["tokens"] for r in small if r["doc_id"] == 1) == [50, 100, 100]
    load = {}
    for r in small:
        load[r["container"]] = load.get(r["container"], 0) + r["tokens"]
    assert max(load.values()) <= 100 and len(load) == 6
    fill = {r["plan_name"]: r for r in packing.fill_rates(out, plans, "plan_name", "capacity").collect()}
    assert fill["small"]["containers"] == 6 and fill["bad"]["containers"] == 0
    assert packing.pack_containers(items.limit(0), "doc_id", "size", plans, "plan_name", "capacity").count() == 0
    assert packing.pack_containers(items, "doc_id", "size", plans.limit(0), "plan_name", "capacity").count() == 0


def test_token_count_is_the_tokenizers(spark):
    texts = ["hello world", "", None, "äöü 中文 " * 50]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(tokens.token_count(F.col("text")).alias("n"))
    assert [r[0] for r in df.collect()] == tokens.count_tokens([t or "" for t in texts])


def docs(spark):
    rows = [(i, f"alpha beta {'word ' * (5 + i % 7)}", ("a", "b", "c", None)[i % 4]) for i in range(400)]
    rows += [(1, rows[1][1], "b"), (1000, None, "a"), (None, "x", "a"), (1001, "", "a")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"id": F.lit(1), "tokens": F.lit(1), "p": F.lit(0), "rate": F.lit(1.0)})


def test_mixture_reaches_the_shares(spark):
    t = spark.createDataFrame([("a", 0.6, 1), ("b", 0.3, 3), ("c", 0.1, 2)], "source string, target_share double, max_repeats int").withColumn("share", F.lit(0))
    m, report = mixing.mix(docs(spark), "doc_id", "text", "source", t)
    rows = {r["source"]: r for r in report.collect()}
    for s, share in (("a", 0.6), ("b", 0.3), ("c", 0.1)):
        assert abs(rows[s]["share"] - share) < 0.01 and rows[s]["repeats"] <= rows[s]["max_repeats"]
    taken = m.collect()
    assert len({r["doc_id"] for r in taken}) == len(taken)


def test_mixture_beyond_the_caps_reports_what_it_reached(spark):
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 2), ("gone", 0.1, 2)], "source string, target_share double, max_repeats int")
    _, report = mixing.mix(docs(spark), "doc_id", "text", "source", t, total_tokens=100_000)
    rows = {r["source"]: r for r in report.collect()}
    # Labelled documents of b are used twice, those that may be of a only once.
    assert rows["a"]["taken_tokens"] == rows["a"]["available_tokens"] and rows["gone"]["share"] == 0
    assert rows["b"]["available_tokens"] < rows["b"]["taken_tokens"] <= 2 * rows["b"]["available_tokens"] and rows["b"]["repeats"] == 2


def test_mixture_does_without_a_source_that_serves_nothing(spark):
    t = spark.createDataFrame([("a", 0.6, 1), ("b", 0.2, 3), ("c", 0.1, 0), ("gone", 0.1, 2)], "source string, target_share double, max_repeats int")
    m, report = mixing.mix(docs(spark), "doc_id", "text", "source", t)
    rows = {r["source"]: r for r in report.collect()}
    assert m.count() > 0 and abs(rows["a"]["share"] - 0.75) < 0.01 and abs(rows["b"]["share"] - 0.25) < 0.01
    assert {s for s, r in rows.items() if r["exhausted"]} == {"c", "gone"} and rows["c"]["share"] == rows["gone"]["share"] == 0


def test_mixture_of_all_tokens_repeats_scarce_sources(spark):
    t = spark.createDataFrame([("a", 0.9, 2), ("b", 0.05, 3), ("c", 0.05, 2)], "source string, target_share double, max_repeats int")
    m, report = mixing.mix(docs(spark), "doc_id", "text", "source", t, total_tokens="all")
    rows = {r["source"]: r for r in report.collect()}
    assert rows["a"]["exhausted"] and not rows["b"]["exhausted"]
    assert rows["a"]["repeats"] == 2 and max(r["copies"] for r in m.collect() if r["source"] == "a") == 2
    assert abs(sum(r["share"] for r in rows.values()) - 1) < 1e-6


def test_uncertain_documents_count_by_their_posteriors(spark):
    """Texts that may be of either source are used, and the report counts them for both."""
    rows = [(i, "same words in every text", ("a", "b", None)[i % 3]) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    t = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 1)], "source string, target_share double, max_repeats int")
    m, report = mixing.mix(df, "doc_id", "text", "source", t, total_tokens="all")
    rows = {r["source"]: r for r in report.collect()}
    assert m.count() > 200 and rows["a"]["available_tokens"] == rows["b"]["available_tokens"] > 100
    assert abs(rows["a"]["share"] - 0.5) < 0.02
    assert sum(r["taken_tokens"] for r in rows.values()) == pytest.approx(sum(r["tokens"] * r["copies"] for r in m.collect()), rel=0.01)


def test_mixture_empty(spark):
    t = spark.createDataFrame([("a", 0.5, 1)], "source string, target_share double, max_repeats int")
    m, report = mixing.mix(docs(spark).limit(0), "doc_id", "text", "source", t)
    assert m.count() == 0 and [r["share"] for r in report.collect()] == [0.0]
    m, report = mixing.mix(docs(spark), "doc_id", "text", "source", t.limit(0))
    assert m.count() == 0 and report.count() == 0


@pytest.mark.parametrize("rates", [[0.5] * 100, [1.25] * 40, [0.0] * 5, [2.0] * 3])
def test_whole_copies_keep_up_with_the_rates(rates):
    rates, sizes = np.array(rates), np.arange(len(rates), 0, -1) * 10
    got = mixing.whole_copies(rates, sizes)
    assert abs((got * sizes).sum() - (rates * sizes).sum()) <= 20 and (got >= np.floor(rates)).all() and (got <= np.ceil(rates)).all()


def exact_pmf(good, bad, draws, upto):
    """P(0..upto) of the hypergeometric distribution in exact fractions."""
    from fractions import Fraction

    p = Fraction(1)
    for i in range(draws):
        p *= Fraction(bad - i, good + bad - i)
    out = [p]
    for x in range(upto):
        out.append(out[-1] * Fraction((good - x) * (draws - x), (x + 1) * (bad - draws + x + 1)))
    return [float(x) for x in out]


@pytest.mark.parametrize("good,bad,draws", [(50_000, 2 * 10**9, 1000), (3, 5 * 10**9, 200), (500_000, 10**9 - 500_001, 800), (40, 60, 25), (4 * 10**9, 6 * 10**9, 9)])
def test_hypergeometric_is_exact_at_every_size(good, bad, draws):
    rng, n = np.random.default_rng(8), 20_000
    got = np.bincount([reservoir.hypergeometric(rng, good, bad, draws) for _ in range(n)], minlength=60)
    want = np.array(exact_pmf(good, bad, draws, min(draws, good, 40)))
    want = np.append(want, max(0.0, 1 - want.sum())) * n
    seen = np.append(got[: len(want) - 1], got[len(want) - 1 :].sum())
    use = want >= 5
    chi = ((seen[use] - want[use]) ** 2 / want[use]).sum() + (seen[~use].sum() - want[~use].sum()) ** 2 / max(want[~use].sum(), 5)
    assert chi < use.sum() + 5 * (2 * use.sum()) ** 0.5 + 5


def test_hypergeometric_of_large_draws_has_the_right_moments():
    rng, (good, bad, draws) = np.random.default_rng(2), (10**11, 3 * 10**11, 10**8)
    x = np.array([reservoir.hypergeometric(rng, good, bad, draws) for _ in range(300)], float)
    mean, sd = draws * 0.25, (draws * 0.25 * 0.75) ** 0.5
    assert abs(x.mean() - mean) < 5 * sd / 300**0.5 and 0.8 < x.std() / sd < 1.2
    assert reservoir.hypergeometric(rng, 5, 0, 3) == 3 and reservoir.hypergeometric(rng, 0, 5, 3) == 0 and reservoir.hypergeometric(rng, 5, 5, 0) == 0


def test_reservoir_with_more_shards_than_batches(spark):
    rows = [(f"p{i}", i, f"s{i // 3:03d}") for i in range(300)]
    df = spark.createDataFrame(rows, ROWS)
    taken = np.zeros(300)
    for seed in range(12):
        s = sample(df, 60, seed=seed, max_batches=8)
        assert len(set(s)) == 60
        taken[[int(x[1:]) for x in s]] += 1
    # Early and late arrivals have the same chance.
    assert abs(taken[:150].sum() - taken[150:].sum()) < 5 * (12 * 60 * 0.25) ** 0.5 * 2
