from __future__ import annotations

import re
from decimal import Decimal

import pytest

from buyerlens.sources.csv import CSV_OPTIONS, csv_records, import_tables, load_table, load_tables, read_csv
from buyerlens.sources.schemas import TABLES
from tests.conftest import at

HEADERS = {name: ",".join(f.name for f in table.schema) for name, table in TABLES.items()}


@pytest.fixture
def deliver(tmp_path):
    def write(name: str, body: str, bom: bool = False) -> str:
        path = tmp_path / f"{name}.csv"
        path.write_bytes((("﻿" if bom else "") + HEADERS[name] + "\n" + body).encode())
        return str(path)

    return write


def test_empty_quoted_and_missing_text_differ(spark, deliver):
    path = deliver("order_reviews", (
        'r1,o1,5,"","He said ""ok"",\nand left",2018-01-01 00:00:00,2018-01-02 10:11:12\n'
        "r2,o2,1,,plain,2018-01-01 00:00:00,2018-01-02 00:00:00\n"
    ))
    rows = {r.review_id: r for r in load_table(spark, "order_reviews", path).collect()}
    assert rows["r1"].review_comment_title == ""
    assert rows["r1"].review_comment_message == 'He said "ok",\nand left'
    assert rows["r1"].review_answer_timestamp == at("2018-01-02T10:11:12")
    assert rows["r2"].review_comment_title is None
    assert rows["r2"].review_comment_message == "plain"


def test_newest_review_is_kept(spark, deliver):
    path = deliver("order_reviews", (
        "r,o1,1,,,2018-01-01 00:00:00,2018-01-05 00:00:00\n"
        "r,o2,4,,,2018-02-01 00:00:00,2018-02-02 00:00:00\n"
        "r,o3,5,,,2018-02-01 00:00:00,2018-02-01 00:00:00\n"
        "s,o4,2,,,2018-01-01 00:00:00,2018-01-01 00:00:00\n"
    ))
    assert read_csv(spark, TABLES["order_reviews"], path).count() == 4
    rows = load_table(spark, "order_reviews", path).collect()
    assert sorted((r.review_id, r.order_id) for r in rows) == [("r", "o2"), ("s", "o4")]


@pytest.mark.parametrize("bom", [False, True])
def test_byte_order_marks_are_removed(spark, deliver, bom):
    path = deliver("product_category_translation", "﻿cama_mesa,bed_table\npc﻿_gamer,pc\n", bom)
    rows = load_table(spark, "product_category_translation", path).collect()
    assert sorted(r.product_category_name for r in rows) == ["cama_mesa", "pc_gamer"]


def test_types_and_missing_numbers(spark, deliver):
    path = deliver("products", "p1,toys,40,287,1,225,16,10,14\np2,,,,,,,,\n")
    df = load_table(spark, "products", path)
    assert [f.dataType for f in df.schema] == [f.dataType for f in TABLES["products"].schema]
    rows = {r.product_id: r for r in df.collect()}
    assert rows["p1"].product_weight_g == 225
    assert rows["p2"].product_category_name is None and rows["p2"].product_weight_g is None


def test_money_is_exact_and_leading_zeros_stay(spark, deliver):
    items = load_table(spark, "order_items", deliver("order_items", "o,1,p,s,2018-01-01 00:00:00,0.10,8.29\n")).first()
    assert (items.price, items.freight_value) == (Decimal("0.10"), Decimal("8.29"))
    customer = load_table(spark, "customers", deliver("customers", "c,u,01409,franca,SP\n")).first()
    assert customer.customer_zip_code_prefix == "01409"


@pytest.mark.parametrize("row", [
    "o,one,p,s,2018-01-01 00:00:00,1.00,1.00",
    "o,1,p,s,never,1.00,1.00",
    "o,1,p,s,2018-01-01 00:00:00,cheap,1.00",
    "o,1,p,s,2018-01-01 00:00:00",
])
def test_a_bad_row_stops_the_load(spark, deliver, row):
    df = load_table(spark, "order_items", deliver("order_items", row + "\n"))
    with pytest.raises(Exception, match="MALFORMED"):
        df.collect()


@pytest.mark.parametrize("name, row", [
    ("order_items", "o,1,p,s,2018-01-01 00:00:00,cheap,1.00"),
    ("products", "p1,toys,40,287,1,heavy,16,10,14"),
    ("products", "p1,toys,40,287,1,225,16,10,99999"),
])
def test_an_import_checks_every_column(spark, deliver, tmp_path, name, row):
    with pytest.raises(Exception, match="MALFORMED"):
        import_tables(spark, {name: deliver(name, row + "\n")}, str(tmp_path / "imported"))


def test_an_import_keeps_types_and_text(spark, deliver, tmp_path):
    path = deliver("order_reviews", 'r,o,5,"","a\n""b""",2018-01-01 00:00:00,2018-01-02 10:11:12\n')
    df = import_tables(spark, {"order_reviews": path}, str(tmp_path / "imported"))["order_reviews"]
    assert [f.dataType for f in df.schema] == [f.dataType for f in TABLES["order_reviews"].schema]
    row = df.first()
    assert (row.review_score, row.review_comment_title, row.review_comment_message) == (5, "", 'a\n"b"')


def test_stray_line_break_is_not_read_as_two_rows(spark, deliver):
    path = deliver("customers", 'c,u,01409,"sao\npaulo",SP\n')
    with pytest.raises(Exception, match="MALFORMED"):
        load_table(spark, "customers", path).collect()
    assert load_table(spark, "customers", path, multiline=True).first().customer_city == "sao\npaulo"


def test_many_tables_at_once(spark, deliver):
    tables = load_tables(spark, {
        "customers": deliver("customers", "c,u,01409,franca,SP\n"),
        "sellers": deliver("sellers", "s,01409,franca,SP\n"),
        "orders": deliver("orders", "o,c,delivered,2018-01-01 10:00:00,,,,2018-01-09 00:00:00\n"),
        "order_payments": deliver("order_payments", "o,1,voucher,1,0.00\n"),
    })
    assert {name: df.count() for name, df in tables.items()} == {
        "customers": 1, "sellers": 1, "orders": 1, "order_payments": 1
    }
    order = tables["orders"].first()
    assert order.order_approved_at is None and order.order_purchase_timestamp == at("2018-01-01T10:00:00")


def review_text(n: int, newline: str = "\n") -> str:
    said = ["plain", "", '""', '"He said ""ok"""', f'"two{newline}lines"', f'"{newline}{newline}a "" b{newline}"', '"a,b"']
    return "".join(
        f"r{k},o{k},{k % 5 + 1},{said[k % 7]},{said[k * 3 % 7]},2018-01-01 00:00:00,2018-01-02 00:00:00{newline}" for k in range(n))


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_one_file_is_read_by_several_tasks(spark, deliver, newline):
    """The same rows as Spark's own reader gives, which takes such a file whole."""
    table = TABLES["order_reviews"]
    path = deliver("order_reviews", review_text(300, newline))
    whole = spark.read.schema(table.schema).options(**CSV_OPTIONS).option("multiLine", "true").csv(path)
    expected = sorted(map(str, whole.collect()))
    assert len(expected) == 300
    for size in ("97", "1000", "1g"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            df = read_csv(spark, table, path)
            assert sorted(map(str, df.collect())) == expected
            assert [f.dataType for f in df.schema] == [f.dataType for f in table.schema]
            lines = spark.read.text(path).rdd.getNumPartitions()
            assert lines > 20 or size == "1g"
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_records_of_several_files_stay_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h\n"x\n\ny"\nlast')
    (tmp_path / "b.csv").write_text("h\n1\n2\n")
    rows = csv_records(spark, str(tmp_path)).collect()
    found = sorted((r.file.rsplit("/", 1)[1], r.record, r.text) for r in rows if r.text)
    assert found == [("a.csv", 1, "h"), ("a.csv", 2, '"x\n\ny"'), ("a.csv", 3, "last"),
                     ("b.csv", 1, "h"), ("b.csv", 2, "1"), ("b.csv", 3, "2")]


@pytest.mark.parametrize("name, body", [("customers", "c,u,01409,franca,SP\n"), ("order_reviews", review_text(1))])
def test_a_header_with_other_names_stops_the_load(spark, tmp_path, name, body):
    names = HEADERS[name].split(",")
    names[0], names[1] = names[1], names[0]
    (tmp_path / "x.csv").write_text(",".join(names) + "\n" + body)
    with pytest.raises(Exception, match="(?i)header"):
        load_table(spark, name, str(tmp_path / "x.csv")).collect()


def test_line_breaks_in_other_tables_can_be_allowed(spark, deliver, tmp_path):
    path = deliver("customers", 'c,u,01409,"sao\npaulo",SP\n')
    found = import_tables(spark, {"customers": path}, str(tmp_path / "imported"), multiline=["customers"])
    assert found["customers"].first().customer_city == "sao\npaulo"


def test_a_file_without_records(spark, deliver):
    assert load_table(spark, "order_reviews", deliver("order_reviews", "")).count() == 0


@pytest.mark.parametrize("size", ["40", "150", "1g"])
@pytest.mark.parametrize("rows_at_once", [2, 10_000])
def test_records_cross_splits_and_batches(spark, tmp_path, size, rows_at_once):
    """Records over several splits and batches, at the first and last line of a file, and files that end inside quotes."""
    bodies = {
        "a.csv": 'h\n"' + "\n".join(f"line {k}" for k in range(40)) + '"\nx\n\n"\n"\ny,"a ""b""\n"',
        "b.csv": '"two\nlines",h\n' + "".join(f'{k},"p""\nq"\n' for k in range(30)),
        "c.csv": "h\n" + "plain\n" * 50 + 'open "\nand\nnever closed',
        "d.csv": '"' + "\n" * 60 + '"',
    }
    expected = []
    for name, body in bodies.items():
        (tmp_path / name).write_text(body)
        records, inside = [], False
        for line in body.removesuffix("\n").split("\n"):
            if inside:
                records[-1] += "\n" + line
            else:
                records.append(line)
            inside ^= line.count('"') % 2 == 1
        expected += [(name, k, text) for k, text in enumerate(records, 1)]
    settings = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1",
                "spark.sql.execution.arrow.maxRecordsPerBatch": str(rows_at_once)}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        found = csv_records(spark, str(tmp_path)).collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert sorted((r.file.rsplit("/", 1)[1], r.record, r.text) for r in found) == sorted(expected)


def test_lines_are_not_shuffled(spark, deliver):
    """Only splits, as one row each, and pieces of records that cross splits are dealt out."""
    path = deliver("order_reviews", review_text(50))
    plan = read_csv(spark, TABLES["order_reviews"], path)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^)]*)\)", plan)
    keys = {tuple(k.split("#")[0].strip() for k in x.split(",") if "#" in k) for x in dealt}
    assert keys == {("file",), ("file", "record")}
