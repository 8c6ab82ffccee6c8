"""The pair rules at both sides of bounds that must not matter."""

import pytest

from siltworks.llm import pairs


def kinds(prompt, answer):
    return pairs.defects(prompt, answer, None, None)


@pytest.mark.parametrize("n", [1, 4, 5, 20, 400])
def test_a_refusal_of_any_length(n):
    assert "refusal" in kinds("How do I sort a list?", "I am sorry, but I cannot help with that request at all, whoever may ask. " * n)
    assert "refusal" not in kinds("How do I sort a list?", "I cannot help with that request. " * n + "Use sorted(list) and read the result.")


@pytest.mark.parametrize("n", [1, 3, 6, 50])
def test_a_prompt_given_back_any_number_of_times(n):
    p = "Name the three longest rivers of the northern province and their sources."
    assert "copied" in kinds(p, " ".join([p] * n))
    assert "copied" not in kinds(p, " ".join([p] * n) + " They are the Ald, the Berr and the Cann." * 12 * n)


def test_short_answers_in_another_language():
    assert "other_language" in kinds("What is the capital of the country?", "首都是北京。")
    assert "other_language" not in kinds("What is the capital of the country?", "Paris.")
    assert "other_language" not in kinds("What is the capital of the country? Answer in Chinese.", "首都是北京。")


@pytest.mark.parametrize("text", ["lorem ipsum", "N/A", "null", "TODO", "[your answer here]", "To be done.", "nil"])
def test_stand_ins_are_empty(text):
    assert kinds("What is 2 + 2?", text) == ["empty"]


def test_every_defect_comes_with_its_rank(spark):
    rows = [(1, "Name the rivers of the north.", "I cannot help with that because", None, None), (2, None, None, None, None), (3, "Say hi.", "<think>so", None, None)]
    df = spark.createDataFrame(rows, "response_id long, prompt string, response string, reasoning string, answer string")
    got = sorted(map(tuple, pairs.broken_pairs(df).collect()))
    assert (1, 2, "refusal") in got and (1, 4, "truncated") in got and (2, 0, "empty") in got and (3, 1, "truncated_trace") in got
    assert dict(map(tuple, pairs.primary_defects(df).collect())) == {1: "refusal", 2: "empty", 3: "truncated"}
