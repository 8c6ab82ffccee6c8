import pytest
from pyspark.sql import functions as F

from siltworks.functions import labels, scores, text
from siltworks.operators import filters, parse


def values(spark, column, rows, schema="t string"):
    df = spark.createDataFrame([(r,) if not isinstance(r, tuple) else r for r in rows], schema)
    return [r[0] for r in df.select(column).collect()]


def test_match_words(spark):
    got = values(spark, text.match_words(F.col("t")), ["What is 2+2?", "foo_bar baz", "Café 中文", " ", None, "ﬁne"])
    assert got == [["what", "is", "2", "2"], ["foo", "bar", "baz"], ["café", "中文"], [], [], ["fine"]]


def test_normalise_and_blanks(spark):
    assert values(spark, text.normalise(F.col("t")), ["  a \t b　c\x1c ", "ﬁ", "", None]) == ["a b c", "fi", "", None]
    assert values(spark, text.is_blank(F.col("t")), ["  \x85", "x", "", None]) == [True, False, True, True]


def test_ngrams_and_truncation(spark):
    assert values(spark, text.ngrams(text.words(F.col("t")), 2), ["a b c", "a", ""]) == [["a b", "b c"], [], []]
    assert values(spark, text.last_words(F.col("t"), 2), ["a  b", "a b  c"]) == ["a  b", "b c"]
    assert values(spark, text.first_words(F.col("t"), 2), ["a b", "a b c d"]) == ["a b", "a b\n… [truncated — 2 more words]"]
    assert values(spark, text.content_id(F.col("t")), ["x"]) == ["sha256:2d711642b726b04401627ca9fbac32f5"]


def test_domains_and_ties(spark):
    got = values(spark, labels.prompt_domain(F.col("t")), ["Solve the equation", "python code", "solve python", "nothing here", None])
    assert got == ["math", "code", "math", "general", "general"]
    assert values(spark, labels.cluster_domain(F.col("t")), ["a poem and a STORY", "java javascript", ""]) == ["writing", "code", "other"]


def test_difficulty(spark):
    assert values(spark, labels.difficulty(F.col("t")), ["short", "Prove it", "w " * 60, "w " * 200, None]) == ["easy", "hard", "medium", "hard", "easy"]


def test_segment_ttr(spark):
    cycle = " ".join(f"w{i % 50}" for i in range(250))
    distinct = " ".join(f"w{i}" for i in range(120))
    got = values(spark, scores.segment_ttr(text.words(F.col("t"))), ["a b c d e a", cycle, distinct, ""])
    assert got[0] == pytest.approx(5 / 6) and got[1:3] == [0.5, 1.0] and got[3] is None


def test_loops(spark):
    assert values(spark, scores.loops(F.col("t")), ["one two three four " * 50, "one two three four " * 8, "", None]) == [True, False, False, False]
    assert values(spark, scores.top_gram_count(text.words(F.col("t")), 2), ["a b a b a b", "a"]) == [3, 0]


def test_contradiction_and_boilerplate(spark):
    rows = [("the valve stays open today", "the valve stays not open"), ("it holds", "it does not"), ("never open valve stays", "not open valve stays")]
    df = spark.createDataFrame(rows, "r string, a string")
    assert [r[0] for r in df.select(scores.contradicts(F.col("r"), F.col("a"))).collect()] == [True, False, False]
    assert values(spark, scores.boilerplate(F.col("t")), ["I don't know.", "As an AI language model", "I do not know the river, but it is long", None]) == [True, True, False, False]


def test_numbers(spark):
    assert values(spark, F.array_sort(scores.concluded_numbers(F.col("t"))), ["so \\boxed{\\frac{1}{2}} and x = -3.5", "none"]) == [["-3.5", "1", "2"], []]
    assert values(spark, scores.formulas(F.col("t")), ["$a+b$ and \\[c\\]"]) == [["a+b", "c"]]
    df = spark.createDataFrame([("2 and 3", "x = 5"), ("5.0", "x = 5"), ("", "x = 5")], "r string, a string")
    assert [r[0] for r in df.select(scores.numbers_disjoint(F.col("r"), F.col("a"))).collect()] == [True, False, False]


@pytest.mark.parametrize(
    ("response", "want"),
    [
        ("<think>a</think><answer>b</answer>", ("a", "b", False, True)),
        ("<think>a</think> b", ("a", "b", False, True)),
        ("x thus y. Therefore z", ("x thus y.", "Therefore z", True, True)),
        ("One. Two three.", ("One.", "Two three.", True, True)),
        ("just words", ("just words", "", True, False)),
        ("so, we go", ("so, we go", "", True, False)),
        ("we see. final answer: 4", ("we see.", "final answer: 4", True, True)),
        ("", ("", "", True, False)),
        (None, ("", "", True, False)),
    ],
)
def test_parse_response(spark, response, want):
    assert tuple(values(spark, parse.parse_response(F.col("t")), [response])[0]) == want


def test_candidates(spark):
    c = F.split("t", r"\|")
    assert values(spark, parse.best_candidate(c)["place"], ["One. Two|<think>a</think>b|<think>abc</think>d", "x|yy"]) == [2, 1]
    assert values(spark, parse.longest_candidate(c), ["a|bb|cc"]) == ["bb"]


def test_prompts_of_values(spark):
    rows = [
        " plain ", "[not json", '["a","b"]', '[{"role":"system","content":"S"},{"role":"user","content":"U"},{"role":"user","content":"V"}]',
        '[{"role":"user","content":" "},{"role":"user","content":"U"}]', '[{"from":"human","value":"H"},{"from":"gpt","value":"G"}]', '{"content":" C "}', '{"other":1}', "", None,
        '[{"role":"assistant","content":"A"}]', '[{"role":"user","content":[{"type":"text","text":"P"},{"text":"Q"}]}]',
    ]
    assert values(spark, parse.prompt_of_value(F.col("t")), rows) == ["plain", "[not json", None, "S\n\nU", "U", "H", "C", None, None, None, None, "P Q"]


def test_annotations_and_generated(spark):
    rows = ['<think>{"x":1}</think>```json\n{"domain":"math","difficulty":"hard","topics":["a"],"language":"de"}\n```', 'noise {"domain":"nope","language":"much too long for this"} tail', "none"]
    got = [tuple(r) for r in values(spark, parse.parse_annotation(F.col("t")), rows)]
    assert got == [("math", ["a"], "hard", "de", ""), ("other", [], "medium", "en", ""), ("other", [], "medium", "en", "")]
    assert values(spark, parse.parse_generated(F.col("t")), ['["short", "a prompt that is long enough"]', 'text "another prompt that is long enough" end']) == [["a prompt that is long enough"], ["another prompt that is long enough"]]


def test_thought_split(spark):
    assert [tuple(r) for r in values(spark, parse.split_thought(F.col("t")), ["a</think>b", "<think>a", "b"])] == [("a", "b", True), ("a", "", False), ("", "b", True)]


def test_chunks_keep_the_covered_tail(spark):
    df = spark.createDataFrame([(1, "x" * 130), (2, ""), (3, None)], "doc_id int, text string")
    rows = parse.chunk_documents(df, "doc_id", "text", least=5, size_tokens=16, overlap_tokens=4).orderBy("chunk_no").collect()
    assert [(r["chunk_no"], len(r["chunk"])) for r in rows] == [(0, 64), (1, 64), (2, 34)] and rows[0]["chunk_id"] == "1:chunk_0000"


WORDS = " ".join(f"w{i}" for i in range(30))


@pytest.mark.parametrize(
    ("record", "family"),
    [
        (("", WORDS, None, None), "missing_prompt"),
        (("p", " ", None, None), "missing_response"),
        (("p", None, None, "a"), "missing_reasoning"),
        (("p", None, "r", " "), "missing_answer"),
        (("p", "few words", None, None), "too_short"),
        (("p", "w " * 8100, None, None), "too_long"),
        (("p", "one two three four " * 60, None, None), "repetition_loop"),
        (("p", None, WORDS, "I don't know."), "boilerplate_answer"),
        (("p", "a b " * 15, None, None), "low_info_density"),
        (("p", None, WORDS, WORDS), None),
    ],
)
def test_chain(spark, record, family):
    df = spark.createDataFrame([record], "prompt string, response string, reasoning string, answer string")
    assert filters.with_reason(df).select(filters.family(F.col("reason"))).first()[0] == family


@pytest.mark.parametrize(
    ("code", "want"),
    [
        ("print(1)", (True, None)),
        (None, (True, None)),
        (">>> 1 + 1", (True, "code_repl_transcript")),
        ("!pip install x", (True, "code_notebook_shell")),
        ("    return 3", (True, "code_fragment")),
        ("def f(:", (False, "code_syntax_error")),
        ("import not_a_module", (True, "code_env_uncertain")),
        ("input()", (True, "code_env_uncertain")),
        ("[][1]", (False, "code_error")),
        ("assert 1 == 2", (False, "code_error")),
        ("while True: pass", (False, "code_timeout")),
        ("import time\nwhile True: time.sleep(1)", (True, "code_long_running")),
    ],
)
def test_code(code, want):
    passed, reason = filters.code_verdict(code, seconds=1.5)
    assert (passed, reason and reason.split(":")[0]) == want


def test_code_and_judge_run_as_stages(spark):
    good, bad = "```python\nprint(1)\n```", "```python\n[][1]\n```"
    rows = [(1, "p", None, WORDS, good, "code"), (2, "p", None, WORDS, bad, "code"), (3, "p", None, WORDS, bad, "math"), (4, "p", "x", None, None, "code")]
    df = spark.createDataFrame(rows, "response_id int, prompt string, response string, reasoning string, answer string, domain string")
    out = {r["response_id"]: r["reason"] for r in filters.run_chain(df, "response_id", judge=lambda b: b["prompt"].str.len() * 0.0 + 1.0, judge_rate=1.0).collect()}
    assert out[1] == "llm_judge" and out[2].startswith("code_error") and out[3] == "llm_judge" and out[4].startswith("too_short")
