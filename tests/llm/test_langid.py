"""Languages of short texts and of languages with few labels."""

import pandas as pd

from siltworks.llm import langid


def test_short_texts_are_a_segment():
    assert langid.segments("Bonjour madame") == [(0, "Bonjour madame")]
    assert langid.segments("  北京  ") == [(2, "北京")]
    assert langid.segments("`x = 1`") == [(0, "`x = 1`")]
    assert langid.segments("12 + 7 = 19") == [] and langid.segments("") == []
    assert langid.segments("This is a whole sentence. Yes") == [(0, "This is a whole sentence.")]


def test_a_rare_language_is_learned_and_short_texts_come_out(spark):
    d = pd.read_parquet("/root/testdata/sf0.01/clustered_prompts.parquet", columns=["prompt", "language"]).dropna()
    rows = [(f"p{i}", p, l) for i, (p, l) in enumerate(zip(d["prompt"], d["language"], strict=True)) if langid.language_code(l) in ("en", "ru")]
    rows += [("pl1", "Proszę wyjaśnić, dlaczego rzeka płynie szybciej wiosną niż jesienią.", "pl"), ("pl2", "Napisz krótkie opowiadanie o starym młynie i jego właścicielu.", "polski")]
    rows += [("new", "Proszę napisać, dlaczego stary młyn stoi przy rzece.", None), ("short", "Старый город", None), ("none", "12 + 7", None), ("nul", None, "en")]
    df = spark.createDataFrame(rows, "prompt_id string, prompt string, language string")
    got = {(r["prompt_id"], r["language"]) for r in langid.segment_languages(df, "prompt_id", "prompt", "language").collect()}
    assert ("new", "pl") in got and ("short", "ru") in got
    assert not [x for x in got if x[0] in ("none", "nul")]
