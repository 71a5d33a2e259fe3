import os

from pyspark.sql import functions as F

from stockweave.streaming import numbering


def append(folder, *lines):
    folder.mkdir(exist_ok=True)
    number = len(list(folder.iterdir()))
    path = folder / f"part-{number}.txt"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (1.7e9 + number, 1.7e9 + number))  # files are taken by age


def opened(spark, folder, files=1):
    return (
        spark.readStream.format("text").option("maxFilesPerTrigger", files).load(str(folder))
    )


def numbers(df):
    return {r["message_number"]: r["value"] for r in df.collect()}


def test_numbers_go_on_over_batches_and_restarts(spark, tmp_path):
    append(tmp_path / "in", "c", "a", "b")
    append(tmp_path / "in", "a", "a")
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    numbering.number_stream(opened(spark, tmp_path / "in"), out, offsets)
    append(tmp_path / "in", "z")
    numbering.number_stream(opened(spark, tmp_path / "in"), out, offsets)
    found = numbers(numbering.numbered_messages(spark, out))
    assert found == {1: "a", 2: "b", 3: "c", 4: "a", 5: "a", 6: "z"}


def test_a_batch_that_runs_again_gets_its_numbers_again(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = [spark.createDataFrame([(f"m{k:03}",) for k in ks], "value string").repartition(5)
            for ks in (range(40), range(100, 117))]
    for batch_id in (0, 1, 0, 1, 1):
        numbering._store_batch(rows[batch_id].repartition(3 + batch_id), batch_id, out, ())
    found = numbers(numbering.numbered_messages(spark, out))
    values = [f"m{k:03}" for k in (*range(40), *range(100, 117))]
    assert found == dict(enumerate(values, 1))


def test_numbering_needs_no_single_task(spark):
    df = spark.range(0, 1000, 1, 8).select(F.col("id").cast("string").alias("value"))
    plan = numbering._sorted(df, ())._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_runs_of_n_join_without_gap_or_repeat(spark, tmp_path):
    for k in range(4):
        append(tmp_path / "in", *(f"{k}{x}" for x in "abcde"))
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")

    def run(n):
        return numbers(numbering.consume_first(opened(spark, tmp_path / "in"), n, out, offsets))

    runs = [run(3), run(0), run(9), run(100), run(5)]
    assert [len(r) for r in runs] == [3, 0, 9, 8, 0]
    append(tmp_path / "in", "new")
    runs.append(run(5))
    joined = {}
    for r in runs:
        assert not joined.keys() & r.keys()
        joined |= r
    expected = [f"{k}{x}" for k in range(4) for x in "abcde"] + ["new"]
    assert joined == dict(enumerate(expected, 1))


def test_a_run_that_failed_before_its_mark_is_repeated(spark, tmp_path):
    append(tmp_path / "in", *"abcdef")
    out, offsets = str(tmp_path / "out"), str(tmp_path / "offsets")
    stream = opened(spark, tmp_path / "in")
    first = numbers(numbering.consume_first(stream, 2, out, offsets))
    marks = tmp_path / "out" / "runs" / "run=0"
    for f in marks.iterdir():  # as if the run had stopped before it could leave its mark
        f.unlink()
    marks.rmdir()
    assert numbers(numbering.consume_first(stream, 2, out, offsets)) == first
    assert numbers(numbering.consume_first(stream, 2, out, offsets)) == {3: "c", 4: "d"}


def test_an_empty_source(spark, tmp_path):
    (tmp_path / "in").mkdir()
    taken = numbering.consume_first(
        opened(spark, tmp_path / "in"), 2, str(tmp_path / "out"), str(tmp_path / "offsets")
    )
    assert taken.columns == ["value", "message_number"] and taken.count() == 0
