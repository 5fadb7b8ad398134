import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tributary.session import CHECKPOINT_KEY, path_exists, scratch_path, shared_dir
from tributary.sources import files, pages, relational

NAMES = ["fecha", "hecho", "n"]


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_latin1_csv_with_missing_tokens(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("fecha,hecho,n\n1/2/2020,Acción,NA\nN/A,\"a, \"\"b\"\"\",7\n,null,nan\n".encode("latin-1"))
    df = files.read_csv(spark, str(tmp_path), NAMES, encoding=files.LATIN1)
    assert as_set(df) == {("1/2/2020", "Acción", None), (None, 'a, "b"', "7"), (None, None, None)}
    unnamed = files.read_csv(spark, str(tmp_path), encoding=files.LATIN1)
    assert unnamed.columns == NAMES and as_set(unnamed) == as_set(df)


def test_header_must_match(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y,z\n1,2,3\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path), NAMES).collect()


def test_csv_without_header(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("0;1;2\nene;Niño;7\nNA;x;\n".encode("latin-1"))
    df = files.read_csv_unnamed(spark, str(tmp_path), NAMES, header_cell="0")
    assert as_set(df) == {("ene", "Niño", "7"), (None, "x", None)}


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('fecha,hecho,n\n1,"two\nlines",3\n')
    df = files.read_csv(spark, str(tmp_path), NAMES, multi_line=True)
    assert as_set(df) == {("1", "two\nlines", "3")}


@pytest.mark.parametrize("reader", [files.read_parquet, files.read_csv])
def test_missing_source_is_named(spark, tmp_path, reader):
    with pytest.raises(files.SourceMissing, match="city"):
        reader(spark, str(tmp_path / "no"), name="city")


def test_csv_keeps_awkward_text(spark):
    df = spark.createDataFrame([('say "x", y', "ñ;ü"), ("back\\slash", "z")], "a string, b string")
    path = scratch_path(spark, "csv")
    files.write_csv(df, path)
    assert as_set(files.read_csv(spark, path, ["a", "b"])) == as_set(df)


def test_partitioned_parquet(spark):
    path = scratch_path(spark, "parquet")
    df = spark.range(10).withColumn("year", (F.col("id") % 2 + 2020).cast("int"))
    files.write_parquet(df, path, ["year"])
    read = files.read_parquet(spark, path).filter("year = 2021")
    assert read.count() == 5 and "PartitionFilters: [isnotnull(year" in read._jdf.queryExecution().toString()


def test_tag_is_replaced(spark):
    tagged = files.tag(files.tag(spark.range(1), "raw"), "final")
    assert tagged.collect()[0]["source"] == "final"


def page_files(folder: Path, sizes):
    """Page files of a service, and all their records."""
    records = [{"id": str(i), "vigencia": str(2010 + i % 5), **({"x": i} if i % 2 else {})} for i in range(sum(sizes))]
    start = 0
    for number, size in enumerate(sizes):
        (folder / f"{number}.json").write_text(json.dumps(records[start : start + size]))
        start += size
    return records


@pytest.mark.parametrize("rows", [0, 3, 10, 12, 15])
@pytest.mark.parametrize("pages_per_task", [1, 2, 5])
def test_paged_source_reads_every_row_once(spark, tmp_path, rows, pages_per_task):
    """Every third page comes short; no row is lost or read twice."""
    records = page_files(tmp_path, [rows])
    path = f"{tmp_path}/0.json"

    def fetch(offset, limit, where):
        import json

        asked = json.load(open(path))[offset : offset + limit]
        return asked[: max(1, len(asked) - 2)] if offset % 3 == 0 else asked

    spark.dataSource.register(pages.paged_source(fetch, lambda where: rows, "test_pages"))
    df = (
        spark.read.format("test_pages")
        .options(columns="id,vigencia,x", pageSize="5", pagesPerTask=str(pages_per_task))
        .load()
    )
    expected = {(r["id"], r["vigencia"], str(r["x"]) if "x" in r else None) for r in records}
    got = df.collect()
    assert len(got) == len(records) and {tuple(r) for r in got} == expected


@pytest.mark.parametrize("counted", [9, 11])
def test_paged_source_fails_on_other_row_counts(spark, counted):
    def fetch(offset, limit, where):
        return [{"id": str(i)} for i in range(10)][offset : offset + limit]

    spark.dataSource.register(pages.paged_source(fetch, lambda where: counted, "changed_pages"))
    df = spark.read.format("changed_pages").options(columns="id", pageSize="4").load()
    with pytest.raises(Exception, match="rows"):
        df.collect()


def test_filters_reach_the_service(spark):
    def fetch(offset, limit, where):
        assert where == [("vigencia", ">=", "2012")]
        return [{"vigencia": "2013"}, {"vigencia": "2012"}][offset : offset + limit]

    source = pages.paged_source(fetch, lambda where: 2 if where else 5, "filtered_pages", True)
    spark.dataSource.register(source)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = spark.read.format("filtered_pages").options(columns="vigencia").load()
        assert as_set(df.filter("vigencia >= '2012'")) == {("2013",), ("2012",)}
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_cells_read_alike_from_both_readers(spark, tmp_path):
    records = [{"a": True, "b": {"x": [1, "é"]}, "c": 1.5}, {"a": None, "b": "t", "c": 7}]
    (tmp_path / "0.json").write_text("\n".join(json.dumps(r, ensure_ascii=False, separators=(",", ":")) for r in records))
    landed = as_set(pages.read_landed(spark, str(tmp_path), ["a", "b", "c"]))
    source = pages.paged_source(lambda o, n, w: records[o : o + n], lambda w: 2, "typed_pages")
    spark.dataSource.register(source)
    assert as_set(spark.read.format("typed_pages").options(columns="a,b,c").load()) == landed


def test_paged_source_raises_errors(spark):
    def fetch(offset, limit, where):
        raise OSError("service is down")

    spark.dataSource.register(pages.paged_source(fetch, lambda where: 1, "broken_pages"))
    df = spark.read.format("broken_pages").options(columns="id").load()
    with pytest.raises(Exception, match="service is down"):
        df.collect()


def test_rows_that_do_not_fit_are_loud(spark, tmp_path):
    (tmp_path / "a.csv").write_text("fecha,hecho,n\n1,2,3\n1,2,3,4\n5\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv(spark, str(tmp_path), NAMES).select("n").collect()
    rows, rejects = files.split_csv(spark, str(tmp_path), NAMES)
    assert as_set(rows) == {("1", "2", "3")} and as_set(rejects) == {("1,2,3,4",), ("5",)}


def test_lines_that_are_no_records_are_loud(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "1"}\n{"id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        pages.read_landed(spark, str(tmp_path), ["id"]).collect()
    rows, rejects = pages.split_landed(spark, str(tmp_path), ["id"])
    assert as_set(rows) == {("1",)} and as_set(rejects) == {('{"id": ',)}


def test_landed_pages(spark):
    path = scratch_path(spark, "pages")
    df = spark.range(23).select(F.col("id").cast("string").alias("id"), F.lit("2012").alias("vigencia"))
    pages.land(df.coalesce(1), path, page_size=5)
    assert len(list(Path(path).glob("*.json"))) == 5
    landed = pages.read_landed(spark, path, ["id", "vigencia", "absent"])
    assert landed.count() == 23 and landed.filter("absent IS NOT NULL").count() == 0


def test_years_compare_as_numbers(spark):
    df = spark.createDataFrame([("2011",), ("2012",), ("900",), ("x",), (None,)], "vigencia string")
    assert as_set(df.filter(pages.from_year(F.col("vigencia"), 2012))) == {("2012",)}


def test_overlapping_pages(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (2, "b", "c")], "id int, x string, y string")
    assert as_set(pages.drop_repeated(df, "id")) == {(1, "a", None), (2, "b", "c")}


def test_jdbc_scan_options():
    with pytest.raises(ValueError, match="split"):
        relational.scan_options("victims")
    assert relational.scan_options("victims", small=True) == {"dbtable": "victims", "fetchsize": "10000"}
    split = relational.scan_options("victims", "id", (1, 1000), 8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "1000", "8")


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get(CHECKPOINT_KEY)
    path = scratch_path(spark, "x")
    assert path.startswith(shared_dir(spark)) and not path_exists(spark, path)
