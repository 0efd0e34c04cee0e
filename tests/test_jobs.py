"""The jobs end to end, by their printed line and exit code."""

import json

import pytest

from tidemark.jobs import main
from tidemark.plans import fixtures as fx
from tidemark.plans import records
from tidemark.sources import files as sources

SF = "/root/testdata/sf0.001"


def run(spark, capsys, *arguments):
    code = main([str(a) for a in arguments], spark)
    return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_resolve(spark, capsys, tmp_path):
    (tmp_path / "in").mkdir()
    for k, value in enumerate(fx.REQUESTS):
        (tmp_path / "in" / f"{k}.json").write_text(value)
    code, said = run(spark, capsys, "resolve", "--requests", f"file://{tmp_path}/in", "--out", f"file://{tmp_path}/out")
    assert (code, said["resolved"], sum(said["refused"].values())) == (1, 4, 14)
    assert sources.read_resolved(spark, f"file://{tmp_path}/out").count() == 4
    code, said = run(spark, capsys, "resolve", "--requests", f"file://{tmp_path}/in/0.json", "--out", f"file://{tmp_path}/out")
    assert (code, said) == (0, {"resolved": 1, "refused": {}, "ok": True})


def test_validate(spark, capsys, tmp_path):
    sources.publish_run(records.flow(spark, SF), f"file://{tmp_path}/runs", "1")
    sources.put_text(spark, f"file://{tmp_path}/contract.json", fx.CONTRACTS[0].replace('"5.1"', '"unknown"').replace('"7"', '"unknown"'))
    asked = ("validate", "--published", f"file://{tmp_path}/runs", "--contract", f"file://{tmp_path}/contract.json", "--out", f"file://{tmp_path}/out")
    code, said = run(spark, capsys, *asked)
    assert (code, said) == (0, {"run": "1", "results": 200, "violations": {}, "ok": True})
    sources.put_text(spark, f"file://{tmp_path}/contract.json", fx.CONTRACTS[0])
    code, said = run(spark, capsys, *asked)
    assert (code, said["violations"]) == (1, {"V10": 200, "V11": 200}) and spark.read.json(f"file://{tmp_path}/out").count() == 200
    with pytest.raises(ValueError, match="no committed run"):
        run(spark, capsys, "validate", "--published", f"file://{tmp_path}/none", "--contract", f"file://{tmp_path}/contract.json", "--out", f"file://{tmp_path}/out")


def test_gate(spark, capsys, tmp_path):
    for name, value in fx.REPORTS:
        (tmp_path / name).write_text(value)
    code, said = run(spark, capsys, "gate", f"file://{tmp_path}/a.sarif", f"file://{tmp_path}/b.sarif")
    assert (code, said["findings"]) == (1, 4) and "r1 7.0 lib/y.sh:12 m1" in said["first"][0] + said["first"][1]
    assert run(spark, capsys, "gate", f"file://{tmp_path}/b.sarif") == (0, {"findings": 0, "first": [], "ok": True})


def test_inspect(spark, capsys, tmp_path):
    (tmp_path / "tree" / "lib").mkdir(parents=True)
    (tmp_path / "tree" / "a.txt").write_text("an Old Name here")
    (tmp_path / "tree" / "lib" / "b.txt").write_text("pinned")
    rules = {"required": ["a.txt", "c.txt"], "forbidden": ["lib/b.txt"], "terms": ["old name"], "needles": [["a.txt", "pin=1", "no pin in a.txt"]]}
    (tmp_path / "rules.json").write_text(json.dumps(rules))
    code, said = run(spark, capsys, "inspect", "--root", f"file://{tmp_path}/tree", "--rules", f"file://{tmp_path}/rules.json")
    assert (code, said["mode"]) == (1, "local")
    assert said["failures"] == ["missing required file: c.txt", "no pin in a.txt", "obsolete file still present: lib/b.txt", "obsolete runtime term 'old name' remains in a.txt"]
    (tmp_path / "rules.json").write_text("{}")
    assert run(spark, capsys, "inspect", "--root", f"file://{tmp_path}/tree", "--rules", f"file://{tmp_path}/rules.json", "--mode", "ci") == (0, {"mode": "ci", "failures": [], "ok": True})


def test_publish(spark, capsys, tmp_path):
    rows = spark.createDataFrame([(1, "ci", "Success", "o/r", "5"), (1, "ci", "Success", "o/r", "5"), (2, "ci", "odd", "o/r", "6")], "event_id long, context string, result string, repository string, run_id string")
    rows.write.parquet(f"file://{tmp_path}/in")
    for _ in range(2):
        assert run(spark, capsys, "publish", "--statuses", f"file://{tmp_path}/in", "--out", f"file://{tmp_path}/out")[0] == 0
        assert sorted((r.event_id, r.state) for r in spark.read.parquet(f"file://{tmp_path}/out").collect()) == [(1, "success"), (2, "error")]
