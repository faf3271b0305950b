import pytest

from tests.test_load import facts_of
from tillstar.plans.load import load_batch
from tillstar.sources.csv_source import SourceUnavailable
from tillstar.streaming.incremental import read_csv_stream, read_parquet_stream, start_load


def days(*numbers):
    return [{"InvoiceNo": f"5{d:02}", "InvoiceDate": f"12/{d}/2010 8:{d:02}"} for d in numbers]


def arrive(raw, folder):
    raw.coalesce(1).write.mode("append").parquet(str(folder))


def run(spark, folder, warehouse, **options):
    stream = read_parquet_stream(spark, str(folder), maxFilesPerTrigger=1)
    start_load(stream, warehouse, **options).awaitTermination()


def test_a_stream_in_pieces_equals_one_batch(spark, lines, tmp_path, new_warehouse):
    landing = tmp_path / "landing"
    # A copy inside one file, a copy in the next file, and a cancelled row.
    arrive(lines(*days(1, 2, 2), {"InvoiceNo": "C1"}), landing)
    arrive(lines(*days(2, 3)), landing)
    warehouse = new_warehouse("stream")
    run(spark, landing, warehouse)
    assert warehouse.state().last_batch is not None

    arrive(lines(*days(4), {"CustomerID": None}, {"InvoiceDate": None, "StockCode": "N"}), landing)
    run(spark, landing, warehouse)

    whole = new_warehouse("batch")
    load_batch(spark.read.parquet(str(landing)), whole)
    assert facts_of(warehouse) == facts_of(whole)
    assert len(facts_of(whole)) == 4
    assert warehouse.get_watermark() == whole.get_watermark()
    codes = [{r.StockCode for r in w.star().products.collect()} for w in (warehouse, whole)]
    assert codes[0] == codes[1] == {"85123A", "N"}


def test_nothing_new_changes_nothing(spark, lines, tmp_path, warehouse):
    landing = tmp_path / "landing"
    arrive(lines(*days(1)), landing)
    run(spark, landing, warehouse)
    before = warehouse.state()
    run(spark, landing, warehouse)
    assert warehouse.state() == before


def test_a_bad_date_stops_the_stream_and_publishes_nothing(spark, lines, tmp_path, warehouse):
    landing = tmp_path / "landing"
    arrive(lines(*days(1), {"InvoiceDate": "soon"}), landing)
    with pytest.raises(Exception, match="bad InvoiceDate"):
        run(spark, landing, warehouse)
    assert warehouse.star().fact.count() == 0


def test_csv_files_can_be_streamed(spark, tmp_path, warehouse):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "a.csv").write_bytes(
        "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
        "1,A,£,6,12/1/2010 8:26,2.55,17850,France\n".encode("latin-1")
    )
    start_load(read_csv_stream(spark, str(landing)), warehouse).awaitTermination()
    assert [r.Description for r in warehouse.star().products.collect()] == ["£"]


def audit_of(warehouse):
    removed = {}
    for row in warehouse.read("load_audit").collect():
        removed[row.step] = removed.get(row.step, 0) + row.removed
    return removed


def test_a_late_row_is_loaded(spark, lines, tmp_path, warehouse):
    landing = tmp_path / "landing"
    arrive(lines(*days(20)), landing)
    arrive(lines({"InvoiceNo": "late", "InvoiceDate": "11/1/2010 8:00"}), landing)
    run(spark, landing, warehouse)
    assert [f[0] for f in facts_of(warehouse)] == ["520", "late"]
    assert warehouse.get_watermark().month == 12


def test_a_batch_load_then_a_stream_of_the_same_rows(spark, lines, tmp_path, warehouse):
    landing = tmp_path / "landing"
    arrive(lines(*days(1, 2)), landing)
    load_batch(spark.read.parquet(str(landing)), warehouse)
    arrive(lines(*days(2, 3)), landing)
    run(spark, landing, warehouse)
    assert [f[0] for f in facts_of(warehouse)] == ["501", "502", "503"]
    assert audit_of(warehouse)["skip_already_loaded"] == 3


def test_two_streams_on_one_warehouse(spark, lines, tmp_path, warehouse):
    for name, day in (("a", 1), ("b", 2)):
        arrive(lines(*days(day)), tmp_path / name)
        run(spark, tmp_path / name, warehouse, checkpoint=str(tmp_path / f"checkpoint-{name}"))
    assert [f[0] for f in facts_of(warehouse)] == ["501", "502"]
    assert len(warehouse.state().batches) == 2


def test_after_a_reset_the_stream_starts_anew(spark, lines, tmp_path, warehouse):
    landing = tmp_path / "landing"
    arrive(lines(*days(1, 2)), landing)
    run(spark, landing, warehouse)
    warehouse.create()
    run(spark, landing, warehouse)
    assert [f[0] for f in facts_of(warehouse)] == ["501", "502"]


def test_a_deleted_checkpoint_loads_nothing_twice(spark, lines, tmp_path, warehouse):
    landing = tmp_path / "landing"
    arrive(lines(*days(1, 2)), landing)
    run(spark, landing, warehouse, checkpoint=str(tmp_path / "one"))
    run(spark, landing, warehouse, checkpoint=str(tmp_path / "two"))
    assert [f[0] for f in facts_of(warehouse)] == ["501", "502"]


def test_the_audit_of_a_stream_is_about_the_raw_rows(spark, lines, tmp_path, warehouse):
    landing = tmp_path / "landing"
    arrive(lines(*days(1, 2, 3, 3), {"CustomerID": None}), landing)
    run(spark, landing, warehouse)
    steps = {r.step: (r.rows_in, r.rows_out) for r in warehouse.read("load_audit").collect()}
    assert steps["drop_null_keys"] == (5, 4) and steps["drop_duplicates"] == (4, 3)


def test_a_lenient_stream_sets_bad_rows_aside(spark, tmp_path, warehouse):
    landing = tmp_path / "landing"
    landing.mkdir()
    head = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    (landing / "a.csv").write_text(
        head + "1,A,x,6,12/1/2010 8:26,2.55,1,France\n2,A,x,6,soon,2.55,1,France\n"
        "3,A,x,6,12/1/2010 8:26,2.55,1,France,more\n4,A,x,six,12/1/2010 8:26,2.55,1,France\n"
    )
    for _ in range(2):
        stream = read_csv_stream(spark, str(landing), strict=False)
        start_load(stream, warehouse, strict=False, checkpoint=str(tmp_path / f"c{_}")).awaitTermination()
    reasons = sorted(r.Reason for r in warehouse.read("rejects").collect())
    assert reasons == ["bad InvoiceDate", "malformed line", "malformed line"]
    assert [f[0] for f in facts_of(warehouse)] == ["1"]


def test_a_missing_folder_is_an_unavailable_source(spark, tmp_path):
    with pytest.raises(SourceUnavailable):
        read_csv_stream(spark, str(tmp_path / "nothing"))


def test_no_python_sees_streamed_rows(spark, lines, tmp_path):
    arrive(lines(*days(1)), tmp_path / "landing")
    stream = read_parquet_stream(spark, str(tmp_path / "landing"))
    assert "Python" not in stream._jdf.queryExecution().analyzed().toString()
