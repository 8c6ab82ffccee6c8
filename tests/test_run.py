"""The command line: stages run once, failed ones again."""

import pytest

from siltworks.__main__ import main
from siltworks.operators.state import RunState

SF = "/root/testdata/sf0.001"


def test_stages_run_once_and_failed_ones_again(spark, tmp_path, capsys):
    run, calls = str(tmp_path / "run"), []

    def good(spark, sf):
        calls.append("good")
        return spark.range(3)

    def bad(spark, sf):
        calls.append("bad")
        if calls.count("bad") == 1:
            raise RuntimeError("no space")
        return spark.range(2)

    known = {"good": good, "bad": bad}
    with pytest.raises(RuntimeError):
        main(["run", SF, run, "good", "bad"], spark, known)
    states = {r["stage"]: (r["status"], r["detail"]) for r in RunState(spark, f"{run}/state").stages().collect()}
    assert states == {"good": ("complete", ""), "bad": ("failed", "no space")}
    assert main(["run", SF, run, "good", "bad"], spark, known) == 0
    assert calls == ["good", "bad", "bad"] and spark.read.parquet(f"{run}/results/bad").count() == 2
    assert main(["run-stage", "good", SF, run], spark, known) == 0 and calls.count("good") == 1
    assert main(["run-stage", "none", SF, run], spark, known) == 2
    assert main(["status", run], spark, known) == 0 and "complete" in capsys.readouterr().out
    assert main(["estimate", SF], spark, known) == 0 and main(["list"], spark) == 0
    out = capsys.readouterr().out
    assert "prompts" in out and "agg1_first_per_id" in out
