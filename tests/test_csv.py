import pytest

from tillstar.operators import cleaning, dimensions
from tillstar.plans.load import load_csv
from tillstar.schemas import RAW, RAW_COLUMNS, SOURCE_POSITION
from tillstar.sources.csv_source import SourceUnavailable, read_csv, source_profile

HEADER = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


@pytest.fixture
def file(tmp_path):
    def write(*rows, header=HEADER):
        path = tmp_path / "data.csv"
        path.write_bytes((header + "".join(r + "\n" for r in rows)).encode("latin-1"))
        return str(path)

    return write


def test_latin_1_and_quotes(spark, file):
    path = file('1,A,"£5, ""gift"" café",6,12/1/2010 8:26,2.55,17850.0,France')
    row = read_csv(spark, path).first()
    assert row.Description == '£5, "gift" café'
    assert (row.Quantity, row.UnitPrice, row.CustomerID) == (6, 2.55, 17850.0)


def test_missing_tokens(spark, file):
    path = file(
        "1,A,,6,12/1/2010 8:26,2.55,,France",
        "2,A,NA,6,12/1/2010 8:26,nan,NULL,N/A",
        "3,A,nothing,6,12/1/2010 8:26,2.55,1,null",
    )
    rows = read_csv(spark, path).orderBy("InvoiceNo").collect()
    assert [r.Description for r in rows] == [None, None, "nothing"]
    assert [r.CustomerID for r in rows] == [None, None, 1.0]
    assert [r.Country for r in rows] == ["France", None, None]
    assert rows[1].UnitPrice is None


def test_spaces_are_kept_for_the_cleaning_to_judge(spark, file):
    row = read_csv(spark, file(" C1,A, X ,6,12/1/2010 8:26,2.55,1,France ")).first()
    assert (row.InvoiceNo, row.Description, row.Country) == (" C1", " X ", "France ")


def test_text_in_a_number_column_fails(spark, file):
    with pytest.raises(Exception, match="cannot read as int"):
        read_csv(spark, file("1,A,X,many,12/1/2010 8:26,2.55,1,France")).collect()


def test_line_breaks_in_quotes_need_the_option(spark, file):
    path = file('1,A,"two\nlines",6,12/1/2010 8:26,2.55,1,France')
    assert read_csv(spark, path, multi_line=True).first().Description == "two\nlines"


def test_a_missing_file(spark, tmp_path):
    with pytest.raises(SourceUnavailable):
        read_csv(spark, str(tmp_path / "absent.csv"))


def test_profile(spark, file):
    path = file("1,A,X,6,12/1/2010 8:26,2.55,1,France", "2,A,X,6,12/1/2010 8:26,2.55,1,France")
    row = source_profile(read_csv(spark, path)).first()
    assert tuple(row) == (2, 8, ",".join(RAW_COLUMNS))


def test_positions_follow_the_file_over_many_splits(spark, file):
    path = file(*[f"{i},A,text {i},6,12/1/2010 8:26,2.55,1,France" for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        rows = read_csv(spark, path)
        assert rows.rdd.getNumPartitions() > 3
        found = [r.InvoiceNo for r in rows.orderBy(SOURCE_POSITION).collect()]
        assert found == [str(i) for i in range(3000)]
        first = dimensions.first_products(cleaning.clean(rows)).first()
        assert first.Description == "text 0"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_the_whole_job_from_a_file(spark, file, warehouse):
    path = file(
        "1,A,LAMP ,6,12/1/2010 8:26,2.55,17850,France",
        "1,A,LAMP ,6,12/1/2010 8:26,2.55,17850,France",
        "2,B,,1,12/2/2010 10:00,1,17850,France",
        "C3,B,,-1,12/2/2010 10:00,1,17850,France",
        "4,B,,1,12/2/2010 10:00,1,,France",
    )
    report = load_csv(spark, path, warehouse)
    assert report.added == {"dim_date": 2, "dim_product": 2, "dim_customer": 1, "fact_sales": 2}
    assert report.nulls["CustomerID"] == 1 and report.nulls["Description"] == 3
    audit = {r.step: r.removed for r in warehouse.read("load_audit").collect()}
    assert audit == {
        "drop_null_keys": 1, "drop_duplicates": 1, "drop_cancelled": 1, "keep_positive": 0
    }
    products = {r.StockCode: r.Description for r in warehouse.star().products.collect()}
    assert products == {"A": "LAMP", "B": None}


def test_the_schema_is_declared():
    assert [f.dataType.simpleString() for f in RAW] == [
        "string", "string", "string", "int", "string", "double", "double", "string"
    ]


HEAD = HEADER
GOOD = "1,A,x,6,12/1/2010 8:26,2.55,1,France\n"


def test_malformed_lines_fail_a_strict_batch_and_are_set_aside_else(spark, tmp_path, new_warehouse):
    bad = ["2,A,x,6,12/1/2010 8:26,2.55,1,France,more", "3,A,x,6,12/1/2010 8:26,2.55,1,,", '4,A,"x,6,12/1/2010']
    (tmp_path / "a.csv").write_text(HEAD + GOOD + "\n".join(bad) + "\n")
    with pytest.raises(cleaning.BadBatch, match="3 malformed lines"):
        load_csv(spark, str(tmp_path / "a.csv"), new_warehouse("strict"))
    lenient = new_warehouse("lenient")
    load_csv(spark, str(tmp_path / "a.csv"), lenient, strict=False)
    assert sorted(r.RawLine for r in lenient.read("rejects").collect()) == sorted(bad)
    assert lenient.star().fact.count() == 1


def test_a_short_line_misses_its_last_fields(spark, tmp_path, warehouse):
    (tmp_path / "a.csv").write_text(HEAD + GOOD + "2,A,x,6,12/1/2010 8:26,2.55,1\n3,B\n")
    load_csv(spark, str(tmp_path / "a.csv"), warehouse)
    assert sorted(r.Country or "" for r in warehouse.star().fact.collect()) == ["", "France"]
    audit = {r.step: r.removed for r in warehouse.read("load_audit").collect()}
    assert audit["drop_null_keys"] == 1


def test_quoted_commas_and_quotes_are_no_fault(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + '1,A,"a, ""b"", c",6,12/1/2010 8:26,2.55,1,"Fr, x"\n2,"A, b"\n')
    rows = read_csv(spark, str(tmp_path / "a.csv")).collect()
    assert [(r.Description, r.Country, r.MalformedLine) for r in rows] == [('a, "b", c', "Fr, x", None), (None, None, None)]


def test_a_line_break_in_quotes_needs_multi_line(spark, tmp_path, new_warehouse):
    (tmp_path / "a.csv").write_text(HEAD + '1,A,"x\ny",6,12/1/2010 8:26,2.55,1,France\n')
    with pytest.raises(cleaning.BadBatch, match="malformed"):
        load_csv(spark, str(tmp_path / "a.csv"), new_warehouse("a"))
    whole = new_warehouse("b")
    load_csv(spark, str(tmp_path / "a.csv"), whole, multi_line=True)
    assert whole.star().products.first().Description == "x\ny"


def test_a_bad_number_is_set_aside_in_a_lenient_load(spark, tmp_path, warehouse):
    (tmp_path / "a.csv").write_text(HEAD + GOOD + "2,A,x,six,12/1/2010 8:26,2.55,1,France\n")
    load_csv(spark, str(tmp_path / "a.csv"), warehouse, strict=False)
    assert [r.RawLine for r in warehouse.read("rejects").collect()] == ["2,A,x,six,12/1/2010 8:26,2.55,1,France"]
