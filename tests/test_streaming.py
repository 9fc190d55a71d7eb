from answerloom.operators.grading import grade_runs
from answerloom.operators.metrics import accuracy_by
from answerloom.operators.passk import outcome_counts, outcome_shapes
from answerloom.plans.pass_at_k import pass_at_k_report
from answerloom.sources.runs import read_runs
from answerloom.streaming.arrivals import arriving_runs, land_arrivals
from answerloom.streaming.passk import follow_pass_at_k, latest_shapes, pass_at_k_so_far
from tests.test_sources import COMPLETION, run_rows, write_run


def test_files_are_landed_once(spark, tmp_path):
    raw, out, checkpoint = (str(tmp_path / d) for d in ("raw", "out", "checkpoint"))
    write_run(raw, "T_a.csv", run_rows())
    write_run(raw, "skipped.csv", run_rows(seed=5))
    for expected in (3, 3):
        land_arrivals(arriving_runs(spark, raw, "T_"), out, checkpoint).awaitTermination(120)
        assert spark.read.parquet(out).count() == expected
    write_run(raw, "T_b.csv", run_rows("power_mh", seed=1, n=4))
    land_arrivals(arriving_runs(spark, raw, "T_"), out, checkpoint).awaitTermination(120)
    landed = spark.read.parquet(out)
    assert landed.count() == 7 and {r.completion for r in landed.collect()} == {COMPLETION}
    assert landed.filter("correct_eval = 1").count() == 4


def test_arriving_files_may_differ_in_their_headers(spark, tmp_path):
    raw, out, checkpoint = (str(tmp_path / d) for d in ("raw", "out", "checkpoint"))
    columns = list(run_rows()[0])
    arrivals = [
        ("a.csv", run_rows(), columns), ("b.csv", run_rows(seed=1, n=4), columns[::-1]),
        ("c.csv", run_rows(seed=2, note="hi"), ["note", "gold", "completion", "seed", "example_id", "method", "shard_id"]),
    ]
    for name, rows, order in arrivals:
        write_run(raw, name, rows, order)
        land_arrivals(arriving_runs(spark, raw, extra=["note"]), out, checkpoint).awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.seed for r in rows) == [0] * 3 + [1] * 4 + [2] * 3
    for r in rows:
        assert r.completion == COMPLETION and r.gold == ("6" if r.example_id in ("e0", "e2") else "7")
        assert (r.note, r.alpha) == (("hi", None) if r.seed == 2 else (None, 4.0))
        assert r.correct_eval == (r.gold == "6")


def test_running_accuracy(spark, tmp_path):
    raw = str(tmp_path / "raw")
    write_run(raw, "a.csv", run_rows())
    query = (
        accuracy_by(grade_runs(arriving_runs(spark, raw)), "method")
        .writeStream.outputMode("complete").format("memory").queryName("accuracy_so_far")
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    try:
        query.processAllAvailable()
        assert spark.table("accuracy_so_far").collect() == [("base", 3, 2 / 3)]
        write_run(raw, "b.csv", run_rows("base", seed=1, n=1))
        query.processAllAvailable()
        assert spark.table("accuracy_so_far").collect() == [("base", 4, 3 / 4)]
    finally:
        query.stop()


def test_pass_at_k_follows_arrivals(spark, tmp_path):
    """After each of three arrivals, the last of them late, the streamed curve is that of a rescan."""
    raw, out, checkpoint = (str(tmp_path / d) for d in ("raw", "shapes", "checkpoint"))
    arrivals = [
        [("a.csv", run_rows(seed=0, n=5)), ("b.csv", run_rows("power_mh", seed=0, n=4))],
        [("c.csv", run_rows(seed=2, n=7) + run_rows(seed=3, n=3)), ("d.csv", run_rows("power_mh", seed=1, n=2, gold=None))],
        [("late.csv", run_rows(seed=1, n=6, completion="\\boxed{7}"))],
        [],
    ]
    assert pass_at_k_so_far(spark, out, 4).collect() == []
    for files in arrivals:
        for name, rows in files:
            write_run(raw, name, rows)
        follow_pass_at_k(grade_runs(arriving_runs(spark, raw)), out, checkpoint).awaitTermination(120)
        batch = grade_runs(read_runs(spark, raw))
        shapes = lambda df: sorted(map(str, df.select("method", "n", "c", "examples").collect()))
        assert shapes(latest_shapes(spark, out)) == shapes(outcome_shapes(outcome_counts(batch)))
        curve = lambda df: sorted((r.method, r.k, r.examples, round(r.pass_at_k, 12)) for r in df.collect())
        assert curve(pass_at_k_so_far(spark, out, 4)) == curve(pass_at_k_report(batch, 4))


def test_a_batch_run_again_gives_the_same_version(spark, tmp_path):
    raw, out, checkpoint = (str(tmp_path / d) for d in ("raw", "shapes", "checkpoint"))
    for name, seed in (("a.csv", 0), ("b.csv", 1)):
        write_run(raw, name, run_rows(seed=seed))
        follow_pass_at_k(grade_runs(arriving_runs(spark, raw)), out, checkpoint).awaitTermination(120)
    before = sorted(map(str, latest_shapes(spark, out).collect()))
    assert sorted(map(str, latest_shapes(spark, out, before=1).collect())) != before
    commits = sorted(int(f.name) for f in (tmp_path / "checkpoint" / "commits").iterdir() if f.name.isdigit())
    (tmp_path / "checkpoint" / "commits" / str(commits[-1])).rename(tmp_path / "lost")  # as if the last batch had not ended
    for crc in (tmp_path / "checkpoint" / "commits").glob(".*.crc"):
        crc.rename(tmp_path / f"lost-{crc.name}")
    follow_pass_at_k(grade_runs(arriving_runs(spark, raw)), out, checkpoint).awaitTermination(120)
    assert sorted(map(str, latest_shapes(spark, out).collect())) == before
