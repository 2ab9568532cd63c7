"""File sources, table sinks."""

from __future__ import annotations

import json
import os

from pyspark.testing import assertDataFrameEqual

from tallyspark.session import shared_dir
from tallyspark.sources import files, tables

CUSTOMER_SCHEMA = "`Customer ID` string, `Customer Name` string, address string"


def test_latin1_multiline_csv(spark, tmp_path):
    path = tmp_path / "customers.csv"
    text = ('Customer ID,Customer Name,address\n'
            'C1,José Nuñez,"Calle 1\nPiso 2"\n'
            'C2,"Smith, Ann",Main St\n')
    path.write_bytes(text.encode("latin-1"))
    df = files.read_csv(spark, str(path), CUSTOMER_SCHEMA, multi_line=True, encoding="latin1")
    rows = sorted(tuple(r) for r in df.collect())
    assert rows == [("C1", "José Nuñez", "Calle 1\nPiso 2"), ("C2", "Smith, Ann", "Main St")]


def test_csv_corrupt_records_are_kept(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("id,price\n1,2.5\n2,abc\n")
    df = files.read_csv(spark, str(path), "id int, price double", corrupt_column="_bad")
    rows = {r["id"]: (r["price"], r["_bad"]) for r in df.collect()}
    assert rows[1] == (2.5, None)
    assert rows[2][0] is None and rows[2][1] == "2,abc"


def test_csv_inference_is_opt_in(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text("a,b\n1,x\n")
    assert dict(files.read_csv(spark, str(path)).dtypes)["a"] == "string"
    assert dict(files.read_csv(spark, str(path), infer=True).dtypes)["a"] == "int"


def test_json_array_multiline(spark, tmp_path):
    path = tmp_path / "orders.json"
    rows = [{"Row ID": 1, "Order ID": "A", "Profit": 1.5},
            {"Row ID": 2, "Order ID": "B", "Profit": -2.25}]
    path.write_text(json.dumps(rows, indent=2))
    df = files.read_json(spark, str(path), "`Row ID` bigint, `Order ID` string, `Profit` double",
                         multi_line=True)
    assert sorted(tuple(r) for r in df.collect()) == [(1, "A", 1.5), (2, "B", -2.25)]


def test_csv_round_trip_with_quotes_and_newlines(spark):
    df = spark.createDataFrame([(1, 'say "hi",\nthen go'), (2, ""), (3, None)],
                               "id bigint, text string")
    path = shared_dir(spark, "t-csv")
    # CSV cannot tell "" from NULL unless NULL has a marker of its own
    files.write_csv(df, path, nullValue="\\N")
    back = files.read_csv(spark, path, "id bigint, text string", multi_line=True,
                          nullValue="\\N")
    assertDataFrameEqual(back, df)


def test_shared_dir_uses_checkpoint_root(spark):
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    path = shared_dir(spark, "x")
    assert root and path.startswith(root.rstrip("/"))
    assert spark.sparkContext.getCheckpointDir()


def test_overwrite_is_idempotent(spark):
    location = shared_dir(spark, "t-tables")
    df = spark.range(5).selectExpr("id", "id * 2 AS twice")
    assert tables.write_table(df, "t_idem", path=f"{location}/t_idem") == 5
    assert tables.write_table(df, "t_idem", path=f"{location}/t_idem") == 5
    assertDataFrameEqual(spark.table("t_idem"), df)
    counts = {r["table"]: r["rows"] for r in tables.read_back_counts(spark, ["t_idem"]).collect()}
    assert counts == {"t_idem": 5}
    assert os.path.isdir(location.replace("file:", ""))


def test_publish_gates_on_stored_rows_and_keeps_old_table_on_failure(spark):
    import pytest

    from tallyspark.operators import quality as qa

    root = shared_dir(spark, "t-publish")
    good = spark.range(4).selectExpr("id", "id % 2 AS k")
    assert tables.publish_tables(spark, {"t_pub": good}, root) == {"t_pub": 4}
    assertDataFrameEqual(spark.table("t_pub"), good)

    seen = {}

    def gate(staged):
        seen.update(staged)
        qa.gate(qa.row_rules(staged["t_pub"], "t_pub", key="k"))  # k repeats: fails

    with pytest.raises(AssertionError, match="unique_key"):
        tables.publish_tables(spark, {"t_pub": spark.range(6).selectExpr("id", "id % 3 AS k")},
                              root, gate)
    assert seen["t_pub"].count() == 6          # the gate saw the stored new version
    assertDataFrameEqual(spark.table("t_pub"), good)  # the published table did not change


def test_publish_repoints_an_existing_table(spark):
    root = shared_dir(spark, "t-repoint")
    first = spark.range(3).selectExpr("id", "id * 10 AS v")
    tables.publish_tables(spark, {"t_repoint": first}, root)
    before = spark.sql("DESCRIBE TABLE EXTENDED t_repoint").filter("col_name = 'Location'").first()
    second = spark.range(5).selectExpr("id", "id * 100 AS v")
    tables.publish_tables(spark, {"t_repoint": second}, root)
    after = spark.sql("DESCRIBE TABLE EXTENDED t_repoint").filter("col_name = 'Location'").first()
    assert before["data_type"] != after["data_type"]
    assertDataFrameEqual(spark.table("t_repoint"), second)
    # a changed schema is re-created
    third = spark.range(2).selectExpr("CAST(id AS string) AS id")
    tables.publish_tables(spark, {"t_repoint": third}, root)
    assertDataFrameEqual(spark.table("t_repoint"), third)


def test_csv_write_keeps_white_space(spark):
    df = spark.createDataFrame([(1, "  lead and trail  "), (2, "\tx ")], "id bigint, text string")
    path = shared_dir(spark, "t-space")
    files.write_csv(df, path)
    assertDataFrameEqual(files.read_csv(spark, path, "id bigint, text string"), df)


def test_csv_write_refuses_what_the_encoding_lacks(spark):
    import pytest

    df = spark.createDataFrame([("smörgås",), ("日本",)], "text string")
    files.write_csv(df.where("text LIKE 's%'"), shared_dir(spark, "t-latin"), encoding="latin1")
    with pytest.raises(Exception, match="MALFORMED_CHARACTER_CODING|ENCODE|unmappable"):
        files.write_csv(df, shared_dir(spark, "t-latin"), encoding="latin1")


def test_csv_columns_by_header(spark, tmp_path):
    import pytest

    (tmp_path / "a.csv").write_text("Kind,Thing ID,Extra\nwood,T1,x\n")
    df = files.read_csv(spark, str(tmp_path), "`Thing ID` string, Kind string")
    assert [tuple(r) for r in df.collect()] == [("T1", "wood")]
    with pytest.raises(ValueError, match="Weight"):
        files.read_csv(spark, str(tmp_path), "`Thing ID` string, Weight double")
    (tmp_path / "b.csv").write_text("Thing ID,Kind,Extra\nT2,iron,y\n")
    with pytest.raises(Exception, match="header"):  # another order in another file
        files.read_csv(spark, str(tmp_path), "`Thing ID` string, Kind string").collect()


def test_partitioned_overwrite_replaces_the_whole_table(spark):
    location = shared_dir(spark, "t-part")
    mark = location.rsplit("-", 1)[-1][:12]
    for name, path in ((f"t_ext_{mark}", f"{location}/ext"), (f"t_managed_{mark}", None)):
        tables.write_table(spark.range(4).selectExpr("id", "id % 2 AS k"), name, path=path,
                           partition_by=["k"])
        new = spark.createDataFrame([(9, 1)], "id bigint, k bigint")
        assert tables.write_table(new, name, path=path, partition_by=["k"]) == 1
        assertDataFrameEqual(spark.table(name), new)


def test_current_database_is_restored(spark):
    before = spark.catalog.currentDatabase()
    location = shared_dir(spark, "t-db")
    name = "t_current_" + location.rsplit("-", 1)[-1][:12]
    with tables.current_database(spark, name, location):
        assert spark.catalog.currentDatabase() == name
        tables.write_table(spark.range(2), "plain_name")
    assert spark.catalog.currentDatabase() == before
    assert spark.table(f"{name}.plain_name").count() == 2


def test_publishing_keeps_a_bounded_number_of_versions(spark):
    root = shared_dir(spark, "t-versions")
    for n in range(4):
        tables.publish_tables(spark, {"t_versions": spark.range(n + 1)}, root, keep_versions=2)
    folder = f"{root}/t_versions".replace("file:", "")
    assert len([d for d in os.listdir(folder) if d.startswith("v-")]) == 2
    assert spark.table("t_versions").count() == 4


def test_json_arrays_one_per_file(spark):
    path = shared_dir(spark, "t-arrays")
    df = spark.range(25).selectExpr("id", "CAST(NULL AS string) AS note")
    files.write_json_arrays(df, path, array_rows=4)
    texts = [r["value"] for r in spark.read.text(path, wholetext=True).collect()]
    assert len(texts) >= 7 and all(1 <= len(json.loads(t)) <= 4 for t in texts)
    assertDataFrameEqual(files.read_json(spark, path, "id bigint, note string", multi_line=True), df)


def test_json_arrays_compressed_are_not_shuffled(spark):
    path = shared_dir(spark, "t-arrays-gz")
    df = spark.range(0, 23, 1, 2).selectExpr("id", "IF(id % 3 = 0, NULL, concat('a\n]}\"', id)) AS note")
    before = set(os.listdir(os.path.dirname(path)))
    files.write_json_arrays(df, path, array_rows=4, compression="gzip")
    assert set(os.listdir(os.path.dirname(path))) - before == {os.path.basename(path)}
    texts = [r["value"] for r in spark.read.text(path, wholetext=True).collect()]
    # tasks of 11 and 12 rows each write their own arrays
    assert sorted(len(json.loads(t)) for t in texts) == [3, 4, 4, 4, 4, 4]
    assert all(n.endswith(".txt.gz") for n in os.listdir(path) if n.startswith("part-"))
    for split in (False, True):
        back = files.read_json(spark, path, "id bigint, note string", multi_line=True, split=split)
        assertDataFrameEqual(back, df)


def test_order_lines_land_compressed(spark, sf_dir, monkeypatch):
    from tallyspark.plans import registry
    from tallyspark.sources import snapshots

    landed, write = [], files.write_json

    def spy(df, path, **options):
        write(df, path, **options)
        landed.append([n for n in snapshots.list_names(spark, path) if n.startswith("part-")])

    monkeypatch.setattr(files, "write_json", spy)
    for name in ("q_json_roundtrip", "q_stream_dedup", "q_stream_enriched_orders", "q_incremental_summary"):
        registry.QUERIES[name](spark, sf_dir)
    assert len(landed) == 5
    assert all(names and all(n.endswith(".json.gz") for n in names) for names in landed)


def test_order_lines_carry_the_product_code_only(spark, sf_dir):
    from tallyspark.plans import star

    plan = star.order_source(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    carried = [line for line in plan.splitlines() if "Project" in line and "l_orderkey" in line]
    assert carried and not any("p_type" in line or "p_brand" in line for line in carried)
