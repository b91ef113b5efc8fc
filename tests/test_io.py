"""Files in, files out."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftwork import schemas
from weftwork.functions import pages
from weftwork.operators import filters, graph, state, udfs
from weftwork.sources import readers, writers


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    if isinstance(content, bytes):
        path.write_bytes(content)
    else:
        path.write_text(content if isinstance(content, str) else json.dumps(content))
    return str(path)


@pytest.mark.parametrize("key", ["builds", "mods", "urls", "data", "items", "records"])
def test_json_wrappers(spark, tmp_path, key):
    path = put(tmp_path / "a.json", {"meta": 1, key: [{"x": 1}, {"x": 2}]})
    assert sorted(r.x for r in readers.read_json(spark, path).collect()) == [1, 2]


def test_json_forms(spark, tmp_path):
    assert readers.read_json(spark, put(tmp_path / "l.json", [{"x": 1}, {"x": 2}])).count() == 2
    assert readers.read_json(spark, put(tmp_path / "o.json", {"x": 1, "y": "z"})).first().y == "z"
    assert [r.value for r in readers.read_json(spark, put(tmp_path / "s.json", {"urls": ["a", "b"]})).collect()] == ["a", "b"]
    assert [r.value for r in readers.read_json(spark, put(tmp_path / "b.json", ["a", "b"])).collect()] == ["a", "b"]


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_import_and_export(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, 'a "q", b'), (2, "c")], "x int, y string")
    path = str(tmp_path / f"out.{fmt}")
    writers.export(df, path)
    back = readers.read_any(spark, path if fmt != "json" else put_lines(tmp_path, path))
    assert {(r.x, r.y) for r in back.collect()} == {(1, 'a "q", b'), (2, "c")}


def put_lines(tmp_path, folder):
    text = "".join(p.read_text() for p in sorted((tmp_path / folder.split("/")[-1]).glob("*.json")))
    return put(tmp_path / "lines.jsonl", text)


def test_import_file_modes(spark, tmp_path):
    path = put(tmp_path / "m.jsonl", '{"x": 1}\n{"x": 2}\n')
    assert readers.import_file(spark, path, "t_import") == 2
    assert readers.import_file(spark, path, "t_import", "append") == 4
    assert readers.import_file(spark, path, "t_import", "replace") == 2
    with pytest.raises(Exception):
        readers.import_file(spark, path, "t_import", "fail")
    assert "t_import" in state.tables(spark)
    state.drop_table(spark, "t_import")
    assert "t_import" not in state.tables(spark)
    with pytest.raises(ValueError):
        readers.read_any(spark, "a.xlsx")


def test_export_query(spark, tmp_path):
    readers.register_pandas(spark, pd.DataFrame({"a": [1, 2, 3]}), "frame_view")
    writers.export_query(spark, "SELECT a FROM frame_view WHERE a > :low", str(tmp_path / "q.parquet"), params={"low": 1})
    assert spark.read.parquet(str(tmp_path / "q.parquet")).count() == 2
    assert filters.query_scalar(spark, "SELECT max(a) FROM frame_view") == 3
    assert filters.query_scalar(spark, "SELECT a FROM frame_view WHERE a > ?", [9]) is None
    assert filters.query_rows(spark, "SELECT a FROM frame_view ORDER BY a")[0] == {"a": 1}
    with pytest.raises(ValueError):
        filters.query_rows(spark, "SELECT a FROM frame_view", limit=2)


def test_sources_from_paths(spark, tmp_path):
    put(tmp_path / "one" / "mods.jsonl", '{"mod_name": "a"}\nbroken\n\n{"mod_name": "b"}\n')
    put(tmp_path / "two" / "mods.jsonl", '{"mod_name": "c"}\n')
    put(tmp_path / "two" / "mods.json", {"mods": [{"mod_name": "old1"}, {"mod_name": "old2"}]})
    put(tmp_path / "three" / "mods.json", [{"mod_name": "bare"}])
    lines = readers.read_records(spark, str(tmp_path / "*/mods.jsonl"), "mod_name string")
    assert {(r.source, r.mod_name) for r in lines.collect()} == {("one", "a"), ("one", "b"), ("two", "c")}
    first = readers.read_dual(spark, str(tmp_path), "mods", "mod_name string")
    assert {(r.source, r.mod_name) for r in first.collect()} == {("one", "a"), ("one", "b"), ("two", "c"), ("three", "bare")}
    other = readers.read_dual(spark, str(tmp_path), "mods", "mod_name string", prefer="json")
    assert {(r.source, r.mod_name) for r in other.collect()} == {("one", "a"), ("one", "b"), ("two", "old1"), ("two", "old2"), ("three", "bare")}


def test_url_lists(spark, tmp_path):
    put(tmp_path / "a" / "urls.json", {"urls": ["https://a/1", "https://a/2"], "totalCount": 2})
    put(tmp_path / "b" / "urls.json", {"urls": [{"url": "https://b/1", "filename": "f"}], "totalCount": 5, "lastUpdated": "x"})
    put(tmp_path / "c" / "urls.json", ["https://c/1"])
    got = {(r.source, r.url) for r in readers.read_urls(spark, str(tmp_path / "*/urls.json")).collect()}
    assert got == {("a", "https://a/1"), ("a", "https://a/2"), ("b", "https://b/1"), ("c", "https://c/1")}
    envelopes = readers.read_url_envelopes(spark, str(tmp_path / "a/urls.json")).first()
    assert (envelopes.totalCount, envelopes.source) == (2, "a")


def test_rejects(spark, tmp_path):
    path = put(tmp_path / "p" / "log.jsonl", '{"url": "u", "status": "success"}\nnot json\n')
    good, bad = readers.read_with_rejects(spark, path, "url string, status string")
    assert good.count() == 1 and [r.line for r in bad.collect()] == ["not json"]
    assert readers.read_tolerant(spark, path, "url string, status string").count() == 1


def test_csv_urls(spark, tmp_path):
    a = put(tmp_path / "My-Site.csv", 'url,price\nhttps://a/1,"1,000"\nhttps://a/1,2\nftp://x,3\n')
    b = put(tmp_path / "two step.csv", "link href,x\n https://b/1?q=%20a ,1\n")
    c = put(tmp_path / "none.csv", "x\n1\n")
    got = {(r.source, r.url) for r in readers.read_csv_urls(spark, {a: "url", b: "link href", c: None}).collect()}
    assert got == {("my_site", "https://a/1"), ("two_step", "https://b/1?q=%20a")}


def test_failure_logs(spark, tmp_path):
    put(tmp_path / "s" / "p.jsonl", '{"url": "u", "status": "blocked", "error": "403"}\n{"url": "v", "status": "success"}\n')
    put(tmp_path / "s" / "p.json", {"failedUrls": [{"url": "w", "error": "x"}]})
    put(tmp_path / "s" / "c.json", {"failed_urls": ["a"], "blocked_urls": ["b"]})
    rows = [sorted((r.source, r.url, r.error) for r in readers.read_failures(spark, str(tmp_path / "s" / f), k).collect()) for f, k in (("p.jsonl", "jsonl"), ("p.json", "json"), ("c.json", "checkpoint"))]
    assert rows == [[("s", "u", "403")], [("s", "w", "x")], [("s", "a", "failed"), ("s", "b", "blocked")]]


def test_pages_and_inventory(spark, tmp_path):
    put(tmp_path / "src" / "html" / "1.html", b"<!DOCTYPE html>" + b"x" * 60)
    put(tmp_path / "src" / "html" / "2.html", bytes([0x1F, 0x8B]) + b"x" * 60)
    put(tmp_path / "src" / "Notes.JSON", "{}")
    read = readers.read_pages(spark, str(tmp_path / "*/html/*.html"))
    got = {(r.source, r.filename, r.reason) for r in read.select("source", "filename", pages.byte_corruption("content").alias("reason")).collect()}
    assert got == {("src", "1.html", "valid"), ("src", "2.html", "gzip_compressed")}
    files = {(r.filename, r.suffix, r.length) for r in readers.file_inventory(spark, str(tmp_path)).collect()}
    assert ("Notes.JSON", ".json", 2) in files and len(files) == 3


def test_graph_round_trip(spark, tmp_path):
    doc = {
        "entities": {"a": {"id": "a", "type": "source", "name": "A", "observations": ["o"], "properties": {"status": "pending", "pipeline": {"urlsFound": 4}}, "createdAt": "2024-01-01T00:00:00Z"},
                     "b": {"id": "b", "type": "build", "name": "B", "observations": [], "properties": {}}},
        "relations": [{"id": "r", "from": "a", "to": "b", "type": "contains_build", "properties": {}}],
    }
    e, r = readers.read_graph(spark, put(tmp_path / "g.json", doc))
    writers.save_graph(e, r, str(tmp_path / "g"))
    writers.graph_views(spark.read.parquet(str(tmp_path / "g/entities")), spark.read.parquet(str(tmp_path / "g/relations")))
    assert spark.table("source_summary").first().urls_found == 4
    assert spark.table("entity_relationships").first().to_entity == "B"
    assert graph.touching(r, e.where("id = 'b'")).count() == 1
    notes = spark.createDataFrame([("a", 2, "y"), ("a", 1, "x"), ("zz", 1, "n")], "id string, at int, note string")
    assert graph.add_observations(e, notes).where("id = 'a'").first().observations == ["o", "x", "y"]
    assert graph.observation_rows(e, notes).where("id = 'a'").count() == 3


def test_appends(spark, tmp_path):
    log = spark.createDataFrame([("u", "f", "success", None, None)], schemas.PROGRESS)
    for _ in range(2):
        writers.append_progress(log, str(tmp_path / "log"))
    assert spark.read.schema(schemas.PROGRESS).json(str(tmp_path / "log")).count() == 2
    events = spark.range(3).select(F.lit("http").alias("event_type"), F.timestamp_seconds("id").alias("timestamp"), "id")
    writers.append_events(events, str(tmp_path / "ev"))
    assert spark.read.parquet(str(tmp_path / "ev")).where("event_type = 'http' and date = '1970-01-01'").count() == 3


def test_save_urls_and_manifest(spark, tmp_path):
    urls = spark.createDataFrame([("https://a/b/My Page",), ("https://a/",)], "url string")
    writers.save_urls(urls, str(tmp_path / "u"), "a", F.lit("2024-01-01"))
    assert spark.read.json(str(tmp_path / "u/urls_meta")).first().totalCount == 2
    names = {r.filename for r in spark.read.json(str(tmp_path / "u/urls")).collect()}
    assert any(n.startswith("My-Page-") for n in names) and any(n.startswith("index-") for n in names)
    done = spark.createDataFrame([("1.html",), ("2.html",)], "filename string")
    files = spark.createDataFrame([("1.html", 7)], "filename string, length bigint")
    writers.write_manifest(done, files, str(tmp_path / "m"))
    assert {(r.filename, r.file_exists) for r in spark.read.json(str(tmp_path / "m")).collect()} == {("1.html", True), ("2.html", False)}
    writers.export_urls_by_source(urls.withColumn("source", F.lit("s")), str(tmp_path / "csv"))
    assert (tmp_path / "csv" / "source=s").is_dir()
    writers.write_envelopes(urls.withColumn("source", F.lit("s")), str(tmp_path / "env"))
    assert spark.read.json(str(tmp_path / "env")).first().totalCount == 2
    assert writers.sorted_urls(urls.union(urls)).count() == 2


def test_log_reading(spark, tmp_path):
    path = put(tmp_path / "l.jsonl", '{"timestamp": "2024-01-01T00:00:01Z", "level": "INFO", "message": "a", "data": {"k": "v"}}\n{"timestamp": "2024-01-01T00:00:02Z", "level": "ERROR", "message": "b"}\n')
    log = readers.read_log(spark, path)
    assert readers.log_tail(log, 1).first().message == "b"
    assert log.where("level = 'INFO'").first().data == {"k": "v"}


def test_udf_errors_are_rows(spark):
    out = udfs.map_rows(spark.range(5), lambda r: 10 // int(r["id"]), T.LongType())
    rows = {r.id: (r.result, r.error) for r in out.collect()}
    assert rows[0][0] is None and rows[0][1].startswith("ZeroDivisionError") and rows[2] == (5, None)
    assert udfs.outcomes(out).first().failed == 1
    assert "error" not in udfs.map_values(spark.range(2), lambda r: 1, T.LongType()).columns


def test_dual_forms_in_part_files(spark, data, tmp_path, monkeypatch):
    """Neither form needs a whole site in one task or one document; sources of part files are those of whole files."""
    from weftwork.plans import catalog_io

    monkeypatch.setattr(catalog_io, "_home", lambda _: str(tmp_path / "io"))
    monkeypatch.setattr(catalog_io, "_DOCUMENT", 100)
    got = {(r.form, r.n) for r in catalog_io.io_dual_lines_first(spark, data).collect()}
    sites = [r[0] % 7 for r in spark.read.parquet(f"{data}/orders.parquet").select("o_custkey").collect()]
    assert got == {("jsonl", sum(s < 5 for s in sites)), ("json", sum(s > 4 for s in sites))}
    documents = list((tmp_path / "io/s3/builds.json").glob("part-*"))
    assert len(documents) > 1 and all(len(json.loads(d.read_text())["builds"]) < 100 for d in documents)
    put(tmp_path / "io/s9/builds.json", {"builds": [{"o_orderkey": 1, "form": "json"}]})
    found = readers.read_dual(spark, str(tmp_path / "io"), "builds", "o_orderkey bigint, form string")
    assert {r.source for r in found.select("source").distinct().collect()} == {"s9", *(f"s{s}" for s in set(sites))}


def test_folders_are_dealt_out_by_their_number(spark, tmp_path, monkeypatch):
    """Small folders are spread over tasks whatever they weigh, a large one is split, a null one is kept, and listing takes few tasks."""
    monkeypatch.setattr(writers, "FOLDERS_PER_TASK", 10)
    rows = [(f"s{i % 60}", f"https://a/{i}") for i in range(240)] + [("hot", f"https://h/{i}") for i in range(100)] + [(None, f"https://n/{i}") for i in range(50)]
    urls = spark.createDataFrame([*rows, ("7", 'x, "y"'), ("a/b=c", "https://b")], "source string, url string")
    writers.export_urls_by_source(urls, path := str(tmp_path / "csv"))
    files = [f.name[:10] for f in (tmp_path / "csv").glob("*/part-*")]
    assert len(set(files)) > 4 and max(map(files.count, files)) < 40
    dealt = writers.by_folder(urls, "source", rows=20)
    held = dealt.withColumn("task", F.spark_partition_id()).groupBy("source", "task").count().collect()
    assert sorted(map(tuple, dealt.collect()), key=repr) == sorted(map(tuple, urls.collect()), key=repr)
    assert len([r for r in held if r.source == "hot"]) > 1 and len([r for r in held if r.source is None]) > 1 and len([r for r in held if r.source == "s1"]) == 1
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, seen, load = spark.conf.get(setting), [], type(spark.read).csv
    monkeypatch.setattr(type(spark.read), "csv", lambda self, *a, **k: (seen.append(int(spark.conf.get(setting))), load(self, *a, **k))[1])
    got = readers.read_urls_by_source(spark, path)
    assert seen == [4 * spark.sparkContext.defaultParallelism] and spark.conf.get(setting) == before
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, urls.collect()), key=repr)
    writers.export_urls_by_source(urls.where("false"), empty := str(tmp_path / "none"))
    assert readers.read_urls_by_source(spark, empty).collect() == []


def test_folders_are_written_and_read_in_batches(spark, data, tmp_path, monkeypatch):
    """No job writes or reads more folders or files than a batch holds, whatever their number, and no URL is lost."""
    from weftwork.plans import catalog_io, standins

    for module, name, n in ((writers, "FOLDERS_PER_JOB", 4), (readers, "FILES_PER_READ", 5), (readers, "FOLDERS_PER_LOOKUP", 2)):
        monkeypatch.setattr(module, name, n, raising=False)
    monkeypatch.setattr(catalog_io, "_home", lambda _: str(tmp_path / "io"))
    read, load, write, save = [], type(spark.read).text, [], type(spark.range(1).write).text
    monkeypatch.setattr(type(spark.read), "text", lambda self, *a, **k: (df := load(self, *a, **k), read.append(len(df.inputFiles())))[0])
    monkeypatch.setattr(type(spark.range(1).write), "text", lambda self, path, *a, **k: (save(self, path, *a, **k), write.append(len(list((tmp_path / "io").glob("**/folder=*")))))[0])
    got = sorted(map(tuple, catalog_io.io_url_lists(spark, data).select("source", "url").collect()))
    want = sorted(map(tuple, standins.log(spark, data).select("source", "url").distinct().collect()))
    sources = len({source for source, _ in want})
    assert got == want and sources > 10
    assert sum(read) >= sources and max(read) <= 5
    assert write[-1] == sources and max(b - a for a, b in zip([0, *write], write)) < sources


def test_urls_of_odd_folder_names(spark, tmp_path, monkeypatch):
    """Batches find the files of a glob and no others, whatever signs are in names; settings come back."""
    for name in ("a", "b,c", "d{e", "f}g", "h*i", "hxi", "j[k]", "jk", "l?m", "n\\o", "p q", "r%20s", "_x", "^y"):
        put(tmp_path / "in" / name / "urls.json", [f"https://{name}/1"])
    put(tmp_path / "in" / "a" / "b,{1}.txt", ["https://a/2"])
    put(tmp_path / "in" / "file", "x")
    (tmp_path / "in" / "none").mkdir()
    monkeypatch.setattr(readers, "FILES_PER_READ", 3, raising=False)
    monkeypatch.setattr(readers, "FOLDERS_PER_LOOKUP", 2, raising=False)
    names = ("spark.sql.files.openCostInBytes", "spark.sql.sources.parallelPartitionDiscovery.parallelism", "spark.sql.hive.filesourcePartitionFileCacheSize")
    before = [spark.conf.get(name) for name in names]
    for pattern, n in (("in/*/urls.json", 14), ("*/*/*.json", 14), ("in/{a,b\\,c}/urls.json", 2), ("in/{a/urls,p q/*}.json", 2), ("in/[a-m]*/u*.{json,txt}", 9),
                       ("in/h\\*i/*", 1), ("in/*/b,*.txt", 1), ("in/*/b,\\{1\\}.*", 1), ("in/a/urls.json", 1), ("in/a", 2)):
        whole = spark.read.text(f"{tmp_path}/{pattern}", wholetext=True).select(F.explode(F.from_json("value", "array<string>")))
        got = sorted(r.url for r in readers.read_urls(spark, f"{tmp_path}/{pattern}").collect())
        assert got == sorted(r[0] for r in whole.collect()) and len(got) == n, pattern
        assert all(pattern == "in/a" or len(spark.read.text(p).inputFiles()) <= 3 for p in readers.file_batches(spark, f"{tmp_path}/{pattern}"))
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_urls(spark, f"{tmp_path}/in/*/no.json")
    assert [spark.conf.get(name) for name in names] == before
