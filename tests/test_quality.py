from pyspark.sql import functions as F

from emberfold.operators import quality as Q
from emberfold.sources.layout import stage_path


def test_line_status(spark):
    cases = {
        '{"a": 1}': "valid", '{"a": 1}  ': "valid", '{"a": 1, "a": 2}': "valid", "[1]": "valid", "12": "valid", '"s"': "valid",
        "": "empty", "  ": "empty", "hello": "malformed", '{"a": 1} x': "malformed", '{"a": 1}{"b": 2}': "malformed",
        '{"a":}': "malformed", "{'a': 1}": "malformed", "[1": "malformed", "1, 2": "malformed",
    }
    df = spark.createDataFrame([(k,) for k in cases], "line STRING")
    got = {r.line: r.s for r in df.select("line", Q.line_status(F.col("line")).alias("s")).collect()}
    assert got == cases


def test_audit_of_files(spark, tmp_path):
    (tmp_path / "one.jsonl").write_text('{"b": 1, "a": 2}\n\n{"a": 1}\nbroken\n{"a": 3, "b": 4}\n')
    (tmp_path / "two.jsonl").write_text("[1]\n")
    (tmp_path / "other.txt").write_text("x\n")
    lines = Q.read_lines(spark, str(tmp_path), glob="*.jsonl").withColumn("file", F.element_at(F.split("file", "/"), -1))
    audit = {r.file: (r.lines, r.valid, r.empty, r.malformed) for r in Q.audit_jsonl(lines).collect()}
    assert audit == {"one.jsonl": (5, 3, 1, 1), "two.jsonl": (1, 1, 0, 0)}
    keys = {(r.file, r["keys"]): r.lines for r in Q.key_sets(lines).collect()}
    assert keys == {("one.jsonl", "a,b"): 2, ("one.jsonl", "a"): 1}
    head = Q.head_lines(lines, 2, [F.col("block_start"), F.col("row_in_task")]).filter("file = 'one.jsonl'")
    assert [r.line for r in head.orderBy("line_no").collect()] == ['{"b": 1, "a": 2}', ""]


def test_head_drops_rows_before_the_shuffle(spark):
    lines = spark.createDataFrame([], "file STRING, line STRING")
    plan = Q.head_lines(lines, 2, [F.col("line")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_stage_folders():
    assert stage_path("s3a://x/", "predictions", "2024-01-05") == "s3a://x/02_prediction_jobs/2024-01-05"
