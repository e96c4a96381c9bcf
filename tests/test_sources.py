import pytest
from pyspark.sql import functions as F

from textforge.operators import evaluate as E
from textforge.session import scratch_path
from textforge.sources import sinks
from textforge.sources import text_files as T


@pytest.fixture
def folder(tmp_path):
    def write(name, body, encoding="utf-8"):
        (tmp_path / name).write_text(body, encoding=encoding)
        return str(tmp_path / name)

    return write


def test_csv_quotes_newlines_and_null_tokens(spark, folder):
    path = folder(
        "a.csv",
        'text,label,n\n"say ""hi"", ok",pos,1\n"two\nlines",neg,2\nNA,None,3\n<NA>,pos,nan\n,neg,5\n',
    )
    df = T.load_labelled(spark, path, "text", "label", infer=True)
    assert dict(df.dtypes)["n"] == "bigint"
    assert [tuple(r) for r in df.collect()] == [
        ('say "hi", ok', "pos", 1),
        ("two\nlines", "neg", 2),
        (None, None, 3),
        (None, "pos", None),
        (None, "neg", 5),
    ]


def test_declared_schema_and_encoding(spark, folder):
    path = folder("l.csv", "text,label\ncafé,-1\nNA,1\n", "latin-1")
    df = T.load_labelled(
        spark, path, "text", "label", encoding="ISO-8859-1", schema="text string, label int"
    )
    assert [tuple(r) for r in df.collect()] == [("café", -1), (None, 1)]


def test_dataset_errors(spark, folder, tmp_path):
    with pytest.raises(T.DatasetError, match="not found"):
        T.load_labelled(spark, str(tmp_path / "none.csv"), "text", "label")
    with pytest.raises(T.DatasetError, match="unsupported"):
        T.load_labelled(spark, folder("a.xyz", "text,label\n"), "text", "label")
    with pytest.raises(T.DatasetError, match="missing required columns: label"):
        T.load_labelled(spark, folder("b.csv", "text\nx\n"), "text", "label")
    with pytest.raises(T.DatasetError, match="no rows"):
        T.load_labelled(spark, folder("c.csv", "text,label\n"), "text", "label")
    with pytest.raises(T.DatasetError, match="empty"):
        T.load_labelled(spark, folder("d.csv", ""), "text", "label")


def test_folder_reads_every_csv(spark, folder, tmp_path):
    folder("one.csv", "text,label\na,1\n")
    folder("two.csv", "text,label\nb,2\n")
    folder("other.txt", "junk\n")
    rows = T.read_csv_folder(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in rows) == [("a", "1"), ("b", "2")]


def test_lines(spark, folder):
    path = folder("t.txt", "  first \n\n \t\nsecond \n")
    assert [r.text for r in T.read_lines(spark, path).collect()] == ["first", "second"]


def test_processed_table_round_trip(spark):
    rows = [(1, ' edge "q" \n two, ', "a"), (2, "plain", "b")]
    df = spark.createDataFrame(rows, "id bigint, text string, label string")
    for fmt in ("csv", "parquet"):
        path = scratch_path(spark, "processed")
        sinks.write_processed(df, path, fmt)
        back = (
            T.read_csv(spark, path, schema=df.schema) if fmt == "csv" else spark.read.parquet(path)
        )
        assert sorted(tuple(r) for r in back.collect()) == rows


def test_reports_and_run_metrics(spark):
    pairs = spark.createDataFrame(
        [("m", 0, 0), ("m", 0, 1), ("m", 1, 1), ("k", 0, 0)], "model string, y int, p int"
    )
    report = E.classification_report(pairs, "y", "p", "model")
    path = scratch_path(spark, "reports")
    sinks.write_report(report, path)
    sinks.write_report(report.filter("model = 'm'"), path)  # replaces only its own model
    assert {r.model for r in spark.read.parquet(path).select("model").distinct().collect()} == {
        "m", "k",
    }
    metrics = sinks.report_metrics(report.filter("model = 'm'"))
    names = {r.metric: round(r.value, 6) for r in metrics.collect()}
    assert names["accuracy"] == 0.666667 and names["0_recall"] == 0.5
    assert names["weighted avg_f1-score"] == 0.666667 and "accuracy_recall" not in names
    runs = scratch_path(spark, "runs")
    sinks.append_run_metrics(metrics, runs, "r1", {"cap": 10})
    sinks.append_run_metrics(metrics, runs, "r2")
    table = sinks.read_run_metrics(spark, runs)
    assert table.count() == 2 * len(names)
    assert table.filter(F.col("params")["cap"] == "10").count() == len(names)


def test_large_file_is_read_in_splits(spark, tmp_path):
    path = tmp_path / "large.csv"
    path.write_text("text,label\n" + "".join(f"some text {i},{i % 3}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        one = T.load_labelled(spark, str(path), "text", "label")
        many = T.load_labelled(spark, str(path), "text", "label", multi_line=False, maxColumns="10")
        assert one.rdd.getNumPartitions() == 1 < many.rdd.getNumPartitions()
        assert one.count() == many.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_repeated_run_is_stored_once(spark, tmp_path):
    path = str(tmp_path / "runs")
    metrics = spark.createDataFrame([("accuracy", 0.5), ("f1", 0.25)], "metric string, value double")
    for _ in range(2):
        sinks.append_run_metrics(metrics, path, "07", {"model": "a"})
    better = metrics.withColumn("value", F.col("value") * 2)
    sinks.append_run_metrics(better, path, "07", {"model": "b"})
    sinks.append_run_metrics(better, path, "08")
    sinks.append_run_metrics(better, path, "07", {"model": "a"})
    rows = sinks.read_run_metrics(spark, path).collect()
    assert sorted((r.run, r.params.get("model"), r.metric, r.value) for r in rows if r.params) == [
        ("07", m, k, v) for m in "ab" for k, v in (("accuracy", 1.0), ("f1", 0.5))
    ]
    assert len(rows) == 6 and {r.run for r in rows} == {"07", "08"}
