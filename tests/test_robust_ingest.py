"""Ingest that survives: changed files, reruns, failures, mixed formats, type drift, equal names."""

import os
import zipfile

import pytest
from pyspark.sql import functions as F

from starforge import config as C
from starforge.plans import pipeline
from starforge.sources import readers
from starforge.sources.sinks import TableStore
from starforge.streaming.ingest import ingest_stream


@pytest.fixture()
def lake(spark, tmpdir_path):
    bronze, root = os.path.join(tmpdir_path, "bronze"), os.path.join(tmpdir_path, "lake")

    class Lake:
        store = TableStore(spark, os.path.join(root, "tables"))

        def put(self, path, text):
            full = os.path.join(bronze, path)
            os.makedirs(os.path.dirname(full), exist_ok=True)
            with open(full, "wb") as fh:
                fh.write(text if isinstance(text, bytes) else text.encode())

        def run(self, name):
            out = pipeline.run(spark, bronze, root, C.Config.load(), run_id=name)
            return {r["status"]: r["n"] for r in out["status"].collect()}, out

        def silver(self, domain, entity):
            return pipeline.silver_entities(spark, os.path.join(root, "silver"), self.store)[(domain, entity)]

        def stream(self):
            ingest_stream(spark, bronze, root, os.path.join(tmpdir_path, "ckpt"), C.Config.load()).awaitTermination(300)

    return Lake()


def test_changed_file_replaces_its_rows_once(lake):
    lake.put("shop/items_2026.csv", "item id,price\nA,1\nB,2\n")
    lake.put("shop/notes_2026.csv", "note id,word\n1,x\n2,y\n")
    assert lake.run("r1")[0] == {"SUCCESS": 2}
    lake.put("shop/items_2026.csv", "item id,price\nA,1\nC,3\nD,4\n")
    assert lake.run("r2")[0] == {"SUCCESS": 1, "SKIPPED": 1}
    for name in ("r3", "r4"):
        assert lake.run(name)[0] == {"SKIPPED": 2}
        assert lake.silver("shop", "items").count() == 3 and lake.silver("shop", "notes").count() == 2


def test_failure_before_publishing_duplicates_nothing(lake, monkeypatch):
    lake.put("shop/items_2026.csv", "item id,price\nA,1\nB,2\n")
    with monkeypatch.context() as m:
        m.setattr(pipeline, "_replaced", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            lake.run("r1")
    assert lake.run("r2")[0] == {"SUCCESS": 1}
    assert lake.silver("shop", "items").count() == 2
    assert lake.store.read("fact_shop_items").count() == 2


def test_batch_and_stream_share_one_catalog(lake):
    lake.put("shop/items_2026.csv", "item id,price\nA,1\n")
    lake.run("r1")
    lake.put("shop/notes_2026.csv", "note id,word\n1,x\n")
    lake.stream()
    paths = [r["path"] for r in lake.store.read("catalog").collect()]
    assert sorted(paths) == ["shop/items_2026.csv", "shop/notes_2026.csv"]
    assert lake.silver("shop", "items").count() == 1


def test_bad_files_do_not_end_the_run(lake):
    lake.put("shop/items_2026.csv", "item id,price\nA,1\n")
    lake.put("shop/broken_2026.json", '[{"a": 1}, {"a": ')
    lake.put("shop/torn_2026.xlsx", b"PK\x03\x04 not a workbook")
    lake.put("shop/odd_2026.xml", "<rows><row>")
    lake.put("shop/old_2026.xls", b"\xd0\xcf\x11\xe0")
    status, out = lake.run("r1")
    assert status == {"SUCCESS": 1, "FAILED": 3, "SKIPPED": 1}
    reasons = {r["path"]: r["reason"] for r in lake.store.read("processing_log").collect()}
    assert reasons["shop/broken_2026.json"].startswith("decode error: JSON: ") and "unsupported" in reasons["shop/old_2026.xls"]
    assert lake.store.read("fact_shop_items").count() == 1


def test_type_drift_widens(lake):
    lake.put("shop/items_202601.csv", "item id,price\nA,1\nB,2\n")
    lake.run("r1")
    lake.put("shop/items_202602.csv", "item id,price\nC,2.5\n")
    assert lake.run("r2")[0] == {"SUCCESS": 1, "SKIPPED": 1}
    silver = lake.silver("shop", "items")
    assert silver.schema["price"].dataType.typeName() == "double"
    assert sorted(r["price"] for r in silver.collect()) == [1.0, 2.0, 2.5]
    fact = lake.store.read("fact_shop_items")
    assert sorted((r["fact_id"], r["price"]) for r in fact.collect())[2] == (3, 2.5) and fact.count() == 3
    lake.put("shop/items_202603.csv", "item id,price\nD,cheap\n")
    lake.run("r3")
    assert lake.silver("shop", "items").schema["price"].dataType.typeName() == "string"


def test_dimension_keeps_the_first_row_of_a_file(lake):
    rows = "".join(f"P{k % 40},name {k},word\n" for k in range(4000))
    lake.put("shop/people_2026.csv", "person id,full name,note\n" + rows)
    lake.run("r1")
    got = {r["person_id"]: r["full_name"] for r in lake.store.read("dim_people").collect()}
    assert got == {f"P{k}": f"name {k}" for k in range(40)}


def test_one_entity_name_in_two_domains(lake):
    lake.put("east/people_2026.csv", "person id,town\nA,x\n")
    lake.put("west/people_2026.csv", "person id,town\nB,y\nC,z\n")
    lake.run("r1")
    assert lake.store.read("dim_east_people").count() == 1 and lake.store.read("dim_west_people").count() == 2


def test_drift_compares_with_the_last_run_only(lake):
    for k, header in enumerate(("item id,price,note", "item id,price,colour", "item id,price,colour")):
        lake.put(f"shop/items_20260{k + 1}.csv", f"{header}\nI{k},1.5,x\n")
        lake.run(f"r{k}")
    got = {(r["run_id"], r["column"], r["change"]) for r in lake.store.read("schema_drift").collect()}
    assert got == {("r1", "note", "removed"), ("r1", "colour", "added")}


def test_lineage_and_review_per_file(lake):
    lake.put("shop/items_2026.csv", "item id,price\nA,1\nA,1\n")
    lake.put("stray_2026.csv", "k,v\n1,2\n")
    lake.run("r1")
    rows = {r["bronze_path"]: r for r in lake.store.read("lineage_log").collect()}
    assert (rows["shop/items_2026.csv"]["rows_in"], rows["shop/items_2026.csv"]["rows_out"]) == (2, 1)
    assert rows["shop/items_2026.csv"]["silver_path"].endswith("domain=shop/entity=items")
    assert "stray_2026.csv" in {r["path"] for r in lake.store.read("review_queue").collect()}


def _paths(tmp, files):
    out = []
    for name, text in files.items():
        with open(os.path.join(tmp, name), "w") as fh:
            fh.write(text)
        out.append(os.path.join(tmp, name))
    return out


def test_json_arrays_and_lines_in_one_group(spark, tmpdir_path):
    df = readers.read_json(spark, _paths(tmpdir_path, {
        "a.json": '[\n {"id": 1, "x": "p"},\n {"id": 2, "x": "q"}\n]', "b.json": '{"id": 3, "y": 5}\n{"id": 4}\n', "c.json": '{"id": 5}'}))
    assert sorted(r["id"] for r in df.collect()) == ["1", "2", "3", "4", "5"]


def test_xml_row_tags_in_one_group(spark, tmpdir_path):
    df = readers.read_xml(spark, _paths(tmpdir_path, {
        "a.xml": "<all><!-- <no> --><cat><n>1</n></cat><cat><n>2</n></cat></all>", "b.xml": "<all><dog><n>3</n><m>4</m></dog><dog><n>5</n></dog></all>"}))
    assert sorted(r["n"] for r in df.collect()) == ["1", "2", "3", "5"]


def test_csv_is_read_in_splits_unless_fields_span_lines(spark, tmpdir_path):
    plain = "id,word\n" + "".join(f'{k},"w, {k}"\n' for k in range(30_000))
    paths = _paths(tmpdir_path, {"plain.csv": plain, "span.csv": 'id,word\n1,"two\nlines"\n2,x\n'})
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = readers.read_csv(spark, paths[:1])
        assert df.rdd.getNumPartitions() > 4
        rows = df.orderBy("_src_row").collect()
        assert [r["id"] for r in rows] == [str(k) for k in range(30_000)] and rows[7]["word"] == "w, 7"
        assert sorted((r["id"], r["word"]) for r in readers.read_csv(spark, paths[1:]).collect()) == [("1", "two\nlines"), ("2", "x")]
        assert readers.read_csv(spark, paths).count() == 30_002
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_tables_are_listed_by_kind(lake):
    lake.put("shop/items_2026.csv", "item id,price\nA,1\n")
    lake.run("r1")
    kinds = lake.store.by_kind()
    assert kinds["fact"] == ["fact_shop_items"] and kinds["cuboid"] == ["cuboids_fact_shop_items"]


def _sheet(rows):
    cells = "".join("<row>" + "".join(f'<c r="{"ABC"[k]}{n + 1}" t="inlineStr"><is><t>{v}</t></is></c>' for k, v in enumerate(r)) + "</row>"
                    for n, r in enumerate(rows))
    return f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{cells}</sheetData></worksheet>'


def test_workbook_with_header_only_sheet_and_repeated_header(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "w.xlsx")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", _sheet([["only", "header"]]))
        z.writestr("xl/worksheets/sheet2.xml", _sheet([["id", "v", "v"], ["1", "7", "8"], ["2", "9", "10"]]))
    df = readers.read_xlsx(spark, [path])
    assert df.columns[:3] == ["id", "v", "v.1"]
    assert sorted((r["id"], r["v"], r["v.1"]) for r in df.select("id", "v", F.col("`v.1`")).collect()) == [("1", "7", "8"), ("2", "9", "10")]


def test_csv_with_line_breaks_is_read_by_many_tasks(spark, tmpdir_path, monkeypatch):
    """Cut in ranges of any size, the rows are those of the reader that takes the file whole."""
    import random
    from starforge.sources import scan
    rng = random.Random(4)
    field = lambda: '"' + "".join(rng.choice(['x', ',', '\n', '""', 'é', ' ', '\r\n']) for _ in range(rng.randint(0, 9))) + '"'
    text = "id,Word,word,\n" + "".join(f"{k},{field()},{field() if k % 3 else 'plain'},{'' if k % 4 else field()}\n" + ("\n" if k % 50 == 0 else "") for k in range(800))
    path = _paths(tmpdir_path, {"span.csv": text})[0]
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    want = sorted(tuple(r) for r in whole.where("id is not null").collect())
    assert len(want) == 800
    files = spark.createDataFrame([("file:" + path, ".csv", os.path.getsize(path))], "uri string, format string, size_bytes long")
    for range_bytes in (997, 4_096, 1 << 20):
        scanned = scan.scan(files, range_bytes, 1).join(files, "uri").checkpoint()
        assert scanned.first()["spans_lines"]
        df = readers.read_csv(spark, [path], scanned=scanned)
        assert df.columns[:4] == whole.columns
        assert sorted(tuple(r)[:4] for r in df.collect()) == want
        tasks = scan.csv_records(scanned).select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks > 1 or range_bytes > len(text)


def test_one_array_json_is_cut_in_ranges(spark, tmpdir_path):
    import json
    import random
    from starforge.sources import scan
    rng = random.Random(5)
    rows = [{"id no": k, "deep": {"a": rng.choice([1, 2.5, "x", None]), "b": [k, {"c": "]"}]}, "text": "".join(rng.choice('\\"[]{},é\n') for _ in range(6))}
            for k in range(300)]
    path = _paths(tmpdir_path, {"a.json": json.dumps(rows, ensure_ascii=False, indent=2)})[0]
    files = spark.createDataFrame([("file:" + path, ".json", os.path.getsize(path))], "uri string, format string, size_bytes long")
    flat = None
    for range_bytes in (700, 1 << 22):
        scanned = scan.scan(files, range_bytes, 1).join(files, "uri").checkpoint()
        df = readers.read_json(spark, [path], scanned=scanned)
        got = sorted((tuple(r)[:-2] for r in df.collect()), key=lambda r: int(r[0]))
        assert df.columns[0] == "id_no" or df.columns[0] == "id no"
        assert [r[0] for r in got] == [str(k) for k in range(300)]
        assert flat in (None, got)
        flat = got
    texts = [r["text"] for r in sorted(df.select(F.col(df.columns[0]).cast("int").alias("k"), "text").collect())]
    assert texts == [r["text"] for r in rows]


def test_unchanged_files_are_not_read_again(lake, spark, monkeypatch):
    from starforge.sources import scan
    lake.put("shop/items_2026.csv", "item id,price\nA,1\n")
    lake.put("shop/notes_2026.json", '[{"note id": 1}]')
    lake.run("r1")
    seen = []
    whole = scan.scan
    monkeypatch.setattr(scan, "scan", lambda files, *a: seen.append(files.count()) or whole(files, *a))
    lake.put("shop/more_2026.csv", "more id,price\nA,1\n")
    assert lake.run("r2")[0] == {"SUCCESS": 1, "SKIPPED": 2}
    assert seen == [1]


def test_stream_trigger_reads_its_own_files(lake, spark, monkeypatch):
    from starforge.sources import catalog, scan
    lake.put("shop/items_2026.csv", "item id,price\nA,1\n")
    lake.stream()
    seen = []
    whole = scan.scan
    monkeypatch.setattr(scan, "scan", lambda files, *a: seen.append(files.count()) or whole(files, *a))
    lake.put("shop/copy_2026.csv", "item id,price\nA,1\n")
    lake.put("shop/other_2026.csv", "item id,price\nB,1\n")
    lake.stream()
    assert seen == [2]
    rows = {r["path"]: r["duplicate_of"] for r in catalog.latest(lake.store.read("catalog")).collect()}
    assert rows == {"shop/items_2026.csv": None, "shop/copy_2026.csv": "shop/items_2026.csv", "shop/other_2026.csv": None}
    lake.stream()                   # nothing new: nothing is read
    assert seen == [2]


def test_gold_reads_new_attempts_and_touched_buckets_only(lake, monkeypatch):
    from starforge.operators import incremental
    lake.put("shop/items_202601.csv", "item id,price\n" + "".join(f"A{k},{k}\n" for k in range(400)))
    lake.put("shop/notes_202601.csv", "note id,score\n1,2\n")
    lake.run("r1")
    ids = {r["item_id"]: r["fact_id"] for r in lake.store.read("fact_shop_items").collect()}
    assert sorted(ids.values()) == list(range(1, 401))
    read = []
    load = incremental.load_fact

    def watched(existing, batch, *a, known=None, **k):
        read.append((known.count(), batch.count()))
        return load(existing, batch, *a, known=known, **k)

    monkeypatch.setattr(incremental, "load_fact", watched)
    lake.put("shop/items_202602.csv", "item id,price\nA7,7\nB1,1\n")
    lake.run("r2")
    (index, rows), = read               # the notes have no new attempt: their fact is not loaded
    assert rows == 2 and 1 <= index < 20        # the index rows in two buckets of 256, of 400
    now = {r["item_id"]: r["fact_id"] for r in lake.store.read("fact_shop_items").collect()}
    assert now == {**ids, "B1": 401}
    lake.run("r3")
    assert len(read) == 1 and lake.store.read("fact_shop_items").count() == 401


@pytest.mark.parametrize("lost", ["fact_shop_items", "keys_fact_shop_items", "cuboids_fact_shop_items"])
def test_gold_after_a_failure_half_way_gives_the_same_keys(lake, monkeypatch, lost):
    lake.put("shop/items_202601.csv", "item id,price\n" + "".join(f"A{k},{k}\n" for k in range(30)))
    lake.run("r1")
    lake.put("shop/items_202602.csv", "item id,price\n" + "".join(f"A{k},{k}\n" for k in range(20, 50)))
    with monkeypatch.context() as m:
        for method in ("append", "replace"):
            def fail(self, name, *a, _do=getattr(TableStore, method), **k):
                if name == lost:
                    raise OSError("lost")
                return _do(self, name, *a, **k)
            m.setattr(TableStore, method, fail)
        with pytest.raises(OSError):
            lake.run("r2")
    lake.run("r3")
    got = {r["item_id"]: r["fact_id"] for r in lake.store.read("fact_shop_items").collect()}
    assert lake.store.read("fact_shop_items").count() == 50 and sorted(got.values()) == list(range(1, 51))
    assert {got[f"A{k}"] for k in range(30)} == set(range(1, 31))
    keys = lake.store.read("keys_fact_shop_items")
    assert keys.count() == 50 and {r["fact_id"] for r in keys.collect()} == set(range(1, 51))
    apex = lake.store.read("cuboids_fact_shop_items").where("cuboid = 'apex'").first()
    assert apex["price_count"] == 50


def test_review_flag_per_file(lake):
    """Two files of one entity: the one with a column nothing is known about is flagged, the other isn't."""
    lake.put("retail/customers_202601.csv", "Customer Id,Email Address\nC1,a@x\n")
    lake.put("retail/customers_202602.csv", "Customer Id,Email Address,Shoe Colour Code\nC2,b@x,red\n")
    lake.run("r1")
    log = {r["path"]: r["needs_review"] for r in lake.store.read("processing_log").collect()}
    assert log == {"retail/customers_202601.csv": False, "retail/customers_202602.csv": True}
    rows = {r["_bronze_path"]: r["_needs_review"] for r in lake.silver("retail", "customers").collect()}
    assert rows == log
    assert {r["path"] for r in lake.store.read("review_queue").collect()} == {"retail/customers_202602.csv"}
