import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from answerloom.operators.grading import grade_runs
from answerloom.operators.metrics import sweep_accuracy
from answerloom.operators.runs import merge_runs, method_params, per_example
from answerloom.plans.evaluate import evaluate, grade_and_land
from answerloom.plans.prepare import prompts_for_shard
from answerloom.sources.problems import cache_problems, read_problems
from answerloom.sources.runs import (
    name_filter,
    read_landed,
    read_runs,
    write_run_csv,
    write_run_files,
)
from answerloom.sources.schemas import RUN_SCHEMA, SCORES_SCHEMA
from answerloom.sources.sweeps import read_sweep

COMPLETION = 'He said "6".\nSo \\boxed{6},\r\nünder "quotes"\n'


def run_rows(method="base", seed=0, n=3, **extra):
    return [
        {
            "task": "T", "model": "org/m", "method": method, "alpha": 4.0, "B": 0, "n_mcmc": 0,
            "temperature": 1.0, "top_p": 1.0, "seed": seed, "shard_id": 0,
            "example_id": f"e{i}", "prompt": "p", "completion": COMPLETION,
            "gold": "6" if i % 2 == 0 else "7", "pred": "6", "correct": 1, "accept_rate": 0.0,
            "num_tokens_generated": 5, "base_loglik_sum": -1.5, "base_loglik_avg": -0.3,
            "avg_entropy": 0.1, **extra,
        }
        for i in range(n)
    ]


def write_run(directory, name, rows, columns=None):
    os.makedirs(directory, exist_ok=True)
    pd.DataFrame(rows)[columns or list(rows[0])].to_csv(f"{directory}/{name}", index=False)


def test_run_files_round_trip(spark, tmp_path):
    write_run(tmp_path, "T__m__base__seed0.csv", run_rows())
    write_run(tmp_path, "T__m__base__seed1.csv", run_rows(seed=1))
    write_run(tmp_path, "other.csv", run_rows(seed=9))
    runs = read_runs(spark, str(tmp_path), contains="__base__")
    assert runs.schema == spark.createDataFrame([], RUN_SCHEMA).schema
    rows = runs.orderBy("seed", "example_id").collect()
    assert [(r.seed, r.example_id) for r in rows] == [(s, f"e{i}") for s in (0, 1) for i in range(3)]
    assert {r.completion for r in rows} == {COMPLETION} and {r.gold for r in rows} == {"6", "7"}
    assert read_runs(spark, str(tmp_path)).count() == 9
    assert read_runs(spark, str(tmp_path / "other.csv")).count() == 3


def test_name_filter_is_a_substring_test():
    assert name_filter("") == "*.csv"
    assert name_filter("a[1]*") == r"*a\[1\]\**.csv"


def test_no_matching_file_raises(spark, tmp_path):
    write_run(tmp_path, "a.csv", run_rows())
    with pytest.raises(FileNotFoundError):
        read_runs(spark, str(tmp_path), contains="zzz")


def test_runs_are_merged_by_name(spark, tmp_path):
    write_run(tmp_path / "a", "a.csv", run_rows())
    some = ["completion", "gold", "seed", "example_id", "method"]
    write_run(tmp_path / "b", "b.csv", run_rows(seed=1), some)
    write_run(tmp_path / "c", "c.csv", run_rows(seed=2, note="hi"), [*some, "note"])
    runs = read_runs(spark, *(str(tmp_path / d) for d in "abc"))
    rows = {r.seed: r for r in runs.filter("example_id = 'e1'").collect()}
    assert rows[0].alpha == 4.0 and rows[1].alpha is None and rows[1].gold == "7"
    assert rows[2].note == "hi" and rows[0].note is None
    assert runs.count() == 9
    with pytest.raises(ValueError):
        merge_runs()


def test_one_folder_may_mix_headers(spark, tmp_path):
    """A full, a reordered and a shorter header with an extra column, each read by name."""
    columns = list(run_rows()[0])
    write_run(tmp_path, "a.csv", run_rows())
    write_run(tmp_path, "b.csv", run_rows(seed=1), columns[::-1])
    write_run(tmp_path, "c.csv", run_rows(seed=2, note="hi"), ["note", "gold", "completion", "seed", "example_id"])
    write_run(tmp_path, "d [1].csv", run_rows(seed=3))
    (tmp_path / "empty.csv").write_text("")
    rows = read_runs(spark, str(tmp_path)).collect()
    assert sorted(r.seed for r in rows) == [s for s in range(4) for _ in range(3)]
    for r in rows:
        assert r.completion == COMPLETION and r.gold == ("7" if r.example_id == "e1" else "6")
        assert (r.note, r.method) == (("hi", None) if r.seed == 2 else (None, "base"))


def test_folders_with_the_name_of_the_given_one(spark, tmp_path):
    root = tmp_path / "runs"
    write_run(root / "base" / "runs", "a.csv", run_rows())
    write_run(root / "runs" / "runs", "b + c%20 d.csv", run_rows(seed=1))
    write_run(root, "e.csv", run_rows(seed=2))
    seeds = lambda path, contains: sorted({r.seed for r in read_runs(spark, str(path), contains=contains).collect()})
    assert seeds(root, "base") == [0] and seeds(root, "") == [0, 1, 2]
    assert seeds(root, "runs") == [0, 1]  # the path itself does not count
    assert seeds(root, "b + c%20") == [1] and seeds(root / "runs", "runs/b") == [1]
    assert seeds(tmp_path / "r*", "base") == [0]
    with pytest.raises(FileNotFoundError):
        read_runs(spark, str(root), str(root / "base"), contains="e.csv")


def test_many_files_are_read_in_one_scan(spark, tmp_path):
    columns = list(run_rows()[0])
    layouts = [columns, columns[::-1], ["note", "seed", "gold"]]
    for k in range(300):
        write_run(tmp_path / f"d{k % 7}", f"r{k}.csv", run_rows(seed=k, n=1, note="x"), layouts[k % 3])
    runs = read_runs(spark, str(tmp_path))
    text = runs._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan csv") == 1 and "Union" not in text
    assert sorted((r.seed, r.gold, r.note, r.method) for r in runs.collect()) == [
        (k, "6", "x" if k % 3 == 2 else None, None if k % 3 == 2 else "base") for k in range(300)
    ]


def test_written_runs_are_found_by_name(spark, tmp_path):
    df = spark.createDataFrame(pd.DataFrame(run_rows() + run_rows(seed=1)), RUN_SCHEMA)
    write_run_csv(df, str(tmp_path / "out"), num_shards=2)
    assert read_runs(spark, str(tmp_path / "out"), contains="T__org_m").count() == 6
    assert {r.seed for r in read_runs(spark, str(tmp_path / "out"), contains="__seed1__").collect()} == {1}
    with pytest.raises(FileNotFoundError):
        read_runs(spark, str(tmp_path / "out"), contains="__seed7__")


def test_empty_cells(spark, tmp_path):
    rows = run_rows(n=2)
    rows[0]["completion"], rows[1]["completion"] = "", "None"
    rows[0]["gold"] = "nan"
    write_run(tmp_path, "a.csv", rows)
    graded = grade_runs(read_runs(spark, str(tmp_path))).orderBy("example_id").collect()
    assert [(r.pred_eval, r.correct_eval) for r in graded] == [("", 0), ("None", 0)]


def test_evaluate_end_to_end(spark, tmp_path):
    write_run(tmp_path / "raw", "T_a.csv", run_rows())
    write_run(tmp_path / "raw", "T_b.csv", run_rows("power_mh", seed=1, n=4))
    graded = grade_and_land(spark, [str(tmp_path / "raw")], str(tmp_path / "graded"), "T_")
    assert graded.count() == 7
    assert os.path.isdir(tmp_path / "graded/method=base/seed=0/shard_id=0")
    out = str(tmp_path / "eval")
    evaluate(graded, out, graded_csv=True)
    scores = spark.read.schema(SCORES_SCHEMA).json(f"{out}/scores.json").collect()
    assert len(scores) == 1 and scores[0].n == 7
    assert scores[0].accuracy == pytest.approx(4 / 7)
    assert scores[0].accuracy_by_method == {"base": pytest.approx(2 / 3), "power_mh": 0.5}
    assert scores[0].accuracy_by_seed == {"0": pytest.approx(2 / 3), "1": 0.5}
    lines = [r.value for r in spark.read.text(f"{out}/per_example.jsonl").collect()]
    records = [json.loads(line) for line in lines]
    assert len(records) == 7 and all(
        list(r) == ["example_id", "seed", "method", "correct", "gold", "pred"] for r in records
    )
    csv = read_runs(spark, f"{out}/merged_with_eval.csv")
    assert csv.count() == 7 and dict(csv.dtypes)["correct_eval"] == "int"
    assert {r.completion for r in csv.collect()} == {COMPLETION}


def test_text_outside_ascii_stays_readable(spark, tmp_path):
    from answerloom.sources.sinks import write_per_example

    df = spark.createDataFrame([("é", "ü")], "gold STRING, pred_eval STRING")
    write_per_example(df, str(tmp_path / "x"))
    line = spark.read.text(str(tmp_path / "x")).head().value
    assert line == '{"example_id":"","seed":-1,"method":"","correct":0,"gold":"é","pred":"ü"}'


def test_per_example_defaults(spark):
    df = spark.createDataFrame([(None, None, "g")], "example_id STRING, seed INT, gold STRING")
    assert per_example(df).collect() == [("", -1, "", 0, "g", "")]


def test_run_csv_directories(spark, tmp_path):
    df = spark.createDataFrame(pd.DataFrame(run_rows()), RUN_SCHEMA)
    write_run_csv(df, str(tmp_path / "out"), num_shards=2)
    (directory,) = [d for d in os.listdir(tmp_path / "out") if d.startswith("run=")]
    assert directory == "run=T__org_m__base__seed0__shard0of2"
    assert read_runs(spark, str(tmp_path / "out" / directory)).count() == 3


def test_landed_runs_are_pruned(spark, tmp_path):
    write_run(tmp_path / "raw", "a.csv", run_rows())
    grade_and_land(spark, [str(tmp_path / "raw")], str(tmp_path / "g"))
    plan = (
        read_landed(spark, str(tmp_path / "g"), f"{RUN_SCHEMA}, correct_eval INT")
        .filter("method = 'base'").agg(F.avg("correct_eval"))
        ._jdf.queryExecution().toString()
    )
    assert "ReadSchema: struct<correct_eval:int>" in plan and "PartitionFilters: [isnotnull(method" in plan


PROBLEMS = [
    {"problem": "1+1?", "solution": "s", "answer": " 2 ", "subject": "a", "level": 3, "unique_id": "u1"},
    {"problem": "é?", "unique_id": "u0"},
]


def test_problems_and_write_once_cache(spark, tmp_path):
    source = tmp_path / "p.jsonl"
    source.write_text("\n".join(json.dumps(p) for p in PROBLEMS), encoding="utf-8")
    problems = read_problems(spark, str(source))
    assert {r.level for r in problems.collect()} == {"3", None}
    cache = str(tmp_path / "cache")
    assert cache_problems(problems, cache).count() == 2
    assert cache_problems(problems.limit(1), cache).count() == 2  # kept
    empty = tmp_path / "empty"
    empty.mkdir()
    (empty / "part.json").write_text("")
    assert cache_problems(problems, str(empty)).count() == 2  # empty is not a cache


def test_prompts_for_a_shard(spark):
    problems = spark.createDataFrame(
        [(p["problem"], p.get("answer"), p["unique_id"]) for p in PROBLEMS],
        "problem STRING, answer STRING, unique_id STRING",
    )
    rows = prompts_for_shard(problems, 1, 2).collect()
    assert [(r.position, r.example_id, r.gold) for r in rows] == [(1, "u1", "2")]
    assert [m.role for m in rows[0].messages] == ["system", "user"]
    assert rows[0].messages[1].content.endswith("\\boxed{}.\n\nProblem:\n1+1?")
    assert rows[0].prompt == (
        "You are a helpful assistant.\n" + rows[0].messages[1].content + "\n"
    )


def test_method_params(spark):
    df = spark.createDataFrame([("base",), ("lowtemp",), ("power_mh",)], "method STRING")
    rows = method_params(df, temperature=0.7, alpha=4, block_size=192, n_mcmc=3).collect()
    assert [(r.B, r.n_mcmc, r.temperature) for r in rows] == [(0, 0, 0.7), (0, 0, 0.25), (192, 3, 0.25)]
    assert method_params(df, alpha=0).collect()[1].temperature == pytest.approx(1e8)


def test_sweep_directories(spark, tmp_path):
    for k, correct in ((1, [1, 0]), (10, [1, 1])):
        os.makedirs(tmp_path / f"nmcmc_{k}")
        lines = [
            json.dumps({"example_id": f"e{i}", "seed": 3, "method": "power_mh", "correct": c, "gold": "1", "pred": "1"})
            for i, c in enumerate(correct)
        ]
        (tmp_path / f"nmcmc_{k}" / "per_example.jsonl").write_text("\n".join(lines))
    sweep = sweep_accuracy(read_sweep(spark, str(tmp_path)), correct="correct")
    assert sorted(map(tuple, sweep.collect())) == [(1, 2, 50.0), (10, 2, 100.0)]


def test_run_files_have_exact_names(spark, tmp_path):
    rows = run_rows(n=4) + run_rows(seed=1) + run_rows("power_mh", n=2)
    df = spark.createDataFrame(pd.DataFrame(rows), RUN_SCHEMA).repartition(5)
    out = str(tmp_path / "out")
    write_run_files(df, out, "example_id", num_shards=2)
    names = [f"T__org_m__{m}__seed{s}__shard0of2.csv" for m, s in (("base", 0), ("base", 1), ("power_mh", 0))]
    assert sorted(f for f in os.listdir(out) if not f.startswith(".")) == names
    frame = pd.read_csv(f"{out}/{names[0]}")  # a reader without Spark
    assert list(frame.columns) == df.columns and list(frame.example_id) == ["e0", "e1", "e2", "e3"]
    assert set(frame.completion) == {COMPLETION}
    back = read_runs(spark, out)
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())) and back.schema == df.schema
    assert read_runs(spark, out, contains="__seed1__").count() == 3
    write_run_files(df.filter("seed = 1").withColumn("gold", F.lit("8")), out, num_shards=2)  # replaced, the others stay
    assert {r.gold for r in read_runs(spark, out, contains="__seed1__").collect()} == {"8"}
    assert read_runs(spark, out).count() == 9


def test_a_job_that_dies_leaves_no_file(spark, tmp_path):
    """One task fails for good when others have written their files already."""
    out = tmp_path / "out"
    df = spark.createDataFrame(pd.DataFrame(run_rows() + run_rows(seed=1) + run_rows(seed=2)), RUN_SCHEMA)
    broken = df.withColumn("gold", F.when(F.col("seed") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("gold")))
    with pytest.raises(Exception, match="lost"):
        write_run_files(broken, str(out))
    assert not out.exists() or [f for f in os.listdir(out) if not f.startswith(".")] == []
    left = out / "_staged-abc"
    left.mkdir(parents=True)
    (left / "x.csv").write_text("half")
    write_run_files(df, str(out))
    assert read_runs(spark, str(out)).count() == 9


def test_report_files(spark, tmp_path):
    from answerloom.sources.sinks import write_report_files

    graded = grade_runs(spark.createDataFrame(pd.DataFrame(run_rows(n=30)), RUN_SCHEMA))
    write_report_files(graded, str(tmp_path / "a"))
    scores = json.loads((tmp_path / "a" / "scores.json").read_text())
    assert scores == {"n": 30, "accuracy": 0.5, "accuracy_by_method": {"base": 0.5}, "accuracy_by_seed": {"0": 0.5}}
    records = [json.loads(line) for line in (tmp_path / "a" / "per_example.jsonl").read_text().splitlines()]
    assert len(records) == 30 and records == sorted(records, key=lambda r: r["example_id"])
    write_report_files(graded, str(tmp_path / "b"), parts=4)
    files = sorted(f for f in os.listdir(tmp_path / "b") if f.startswith("per_example"))
    assert 1 < len(files) <= 4 and sum(len((tmp_path / "b" / f).read_text().splitlines()) for f in files) == 30
