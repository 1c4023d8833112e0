import json
import random
import threading
import time
import tracemalloc
import zipfile
import zlib
from http.client import HTTPConnection

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexspan import index_queries, queries
from lexspan.functions import text as T
from lexspan.operators import document
from lexspan.operators import signatures as signatures_
from lexspan.operators.chunking import ChunkSize, chunk_documents, in_ingest_order, searchable
from lexspan.operators.document import join_overlapping, read_document, reassemble, reassemble_exactly
from lexspan.operators.scoring import unique_queries
from lexspan.operators.search import search, search_many
from lexspan.operators.shards import Effect, assign_shards, next_fit, shard_descriptors, starts
from lexspan.plans.http import serve, start
from lexspan.plans.rebuild import Rebuild
from lexspan.plans.service import Service
from lexspan.sources.files import discover, extract, extract_one, list_files, source_map
from lexspan.sources.ndjson import numbered, parse_lines, read_ndjson, to_lines, write_shards
from lexspan.sources.pdf import pdf_text
from lexspan.sources.store import Store, validate
from lexspan.streaming.ingest import commit_batch, ingest_into, ingest_stream


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(compare, name):
    compare(queries.queries()[name], queries.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(index_queries.oracle_sql()))
def test_index_query_equals_sql(compare, name):
    compare(index_queries.queries()[name], index_queries.oracle_sql()[name])


def model_chunks(text, size=1400, step=1200):
    cleaned = " ".join(text.split())
    cut = [cleaned[i : i + size].strip() for i in range(0, len(cleaned), step)]
    return [c for c in cut if c]


@pytest.mark.parametrize("n", [0, 1, 1199, 1200, 1201, 1210, 1219, 1220, 1400, 5000])
def test_chunks_at_the_edges(spark, n):
    r = random.Random(n)
    text = "".join(r.choice("abc de😀") for _ in range(n))
    df = chunk_documents(spark.createDataFrame([("a/b/c.pdf", text)], "file string, text string"))
    assert [r["content"] for r in df.orderBy("chunk_no").collect()] == model_chunks(text)
    exact = reassemble_exactly(df).collect()
    assert [r["text"] for r in exact] == ([" ".join(text.split())] if text.split() else [])


@pytest.mark.parametrize("size, overlap", [(200, 0), (200, 60), (200, 100), (200, 150), (200, 199), (333, 200)])
def test_windows_that_reach_into_many_blocks(spark, size, overlap):
    r = random.Random(size + overlap)
    text = "".join(r.choice("abc de😀\n") for _ in range(1500))
    df = chunk_documents(spark.createDataFrame([("a/b", text), ("a/c", None), ("a/d", " \n ")], "file string, text string"), ChunkSize(size, overlap))
    got = [tuple(r) for r in df.select("file", "chunk_no", "content").orderBy("file", "chunk_no").collect()]
    assert got == [("a/b", k, c) for k, c in enumerate(model_chunks(text, size, size - overlap))]
    assert [r["text"] for r in reassemble_exactly(df).collect()] == [" ".join(text.split())]


def test_chunking_takes_linear_time(spark):
    def seconds(mb):
        docs = spark.range(1).select(F.lit("a/b").alias("file"), F.repeat(F.lit("some wörds of a text that goes on. "), mb * 28_000).alias("text"))
        began = time.time()
        row = chunk_documents(docs).agg(F.count("*"), F.max("start")).first()
        assert row[0] > mb * 800
        return time.time() - began

    seconds(4)
    # Twice the text takes twice the time; a cut that walks from the beginning takes four times.
    assert min(seconds(16) for _ in range(2)) <= 3 * min(seconds(8) for _ in range(2))


def test_unique_queries():
    assert unique_queries(["The  that", "the that", " the  that ", "", "État", "etat", None, "für", "FUR"]) == ["The  that", "the that", "État", "für"]
    assert unique_queries([str(k) for k in range(12)]) == [str(k) for k in range(8)] and unique_queries("a") == ["a"]


def test_reassembly_of_periodic_text_follows_the_longest_overlap(spark):
    df = chunk_documents(spark.createDataFrame([("f", "x" * 3000)], "file string, text string"))
    assert len(reassemble(df).first()["text"]) == 1800
    assert len(reassemble_exactly(df).first()["text"]) == 3000
    assert join_overlapping("", "a") == "a" and join_overlapping("a", "") == "a" and join_overlapping("abc", "abc") == "abc abc"


def test_chunk_size_bounds():
    assert ChunkSize(10, 500) == ChunkSize(200, 199) and ChunkSize(300, -5).step == 300
    with pytest.raises(TypeError):
        ChunkSize("x")


def table(spark, rows):
    df = spark.createDataFrame(rows, "file string, folder string, content string, doc_ord long, chunk_no int")
    return searchable(df)


def test_top_k_is_a_prefix_and_ties_keep_ingest_order(spark):
    chunks = table(spark, [(f"02_LAW/x/{i}.pdf", "x", "alpha beta", 9 - i, 0) for i in range(9)] + [("00_GPT_CONFIGURATION/a.pdf", "x", "alpha beta", 0, 0)])
    best = [r["file"] for r in search(chunks, "alpha beta", 5).collect()]
    assert best == [f"02_LAW/x/{i}.pdf" for i in (8, 7, 6, 5, 4)]
    assert [r["file"] for r in search(chunks, "alpha beta", 4).collect()] == best[:4]
    assert search(chunks, ["the"], 5).count() == 0 and search(chunks, [], 5).count() == 0
    plan = search(chunks, queries.QUERIES)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("replace(") == len({t for q in queries.QUERIES for t in q.split()})
    assert search_many(chunks, {"a": ["alpha beta"], "b": ["gamma delta"], "c": []}, 2).groupBy("query_set").count().collect() == [("a", 2)]
    assert search_many(chunks, {}).count() == 0


def test_a_hundred_sets_are_one_scan_and_a_hundred_searches(spark, tmp_path):
    r = random.Random(5)
    words = [*"alpha beta gamma delta law space state the and état".split(), "space-law", "a'b\\"]
    rows = [(f"0{1 + k % 5}_X/{r.choice(words)}/{k}.pdf", "x", " ".join(r.choice(words) for _ in range(r.randint(0, 12))), k, 0) for k in range(120)]
    table(spark, rows).write.parquet(f"{tmp_path}/c")
    chunks = spark.read.parquet(f"{tmp_path}/c")
    sets = {f"s{k}": [" ".join(r.choice(words) for _ in range(r.randint(1, 4))) for _ in range(r.randint(1, 4))] for k in range(100)}
    many = search_many(chunks, sets, 3)
    assert many._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("FileScan parquet") == 1
    found = {}
    for row in many.orderBy("query_set", F.desc("score"), "doc_ord").collect():
        found.setdefault(row["query_set"], []).append(tuple(row)[1:])
    for name in list(sets)[:25]:
        assert found.get(name, []) == [tuple(row) for row in search(chunks, sets[name], 3).collect()]


def test_top_k_plan_and_pushdown(spark, tmp_path):
    table(spark, [("02_LAW/x/a.pdf", "x", "alpha beta", 1, 0)]).write.parquet(f"{tmp_path}/c")
    chunks = spark.read.parquet(f"{tmp_path}/c")
    plan = search(chunks, "alpha beta")._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan and "Not(StringStartsWith(file" in plan and "Python" not in plan and "Exchange" not in plan
    assert "EqualTo(file," in read_document(chunks, "02_LAW/x/a.pdf")._jdf.queryExecution().toString()


def test_ingest_order_is_collated(spark):
    files = ["_b", "10", "2", "a", "A", "B", "é", "f"]
    df = in_ingest_order(spark.createDataFrame([(f,) for f in files], "file string"))
    assert [r["file"] for r in df.orderBy("doc_ord").collect()] == files


def sequential(sizes, limit):
    """Shard number, from 1, of each size in order."""
    out, shard, used = [], 1, 0
    for size in sizes:
        if used and used + size > limit:
            shard, used = shard + 1, 0
        out.append(shard)
        used += size
    return out


@pytest.mark.parametrize("seed", range(4))
def test_effects_of_ranges_compose(seed):
    r = random.Random(seed)
    for _ in range(150):
        limit = r.choice([5, 10, 30, 100])
        sizes = np.array([r.randint(1, r.choice([3, limit + 5])) for _ in range(r.randint(0, 60))], np.int64)
        parts = np.split(sizes, sorted(r.randint(0, len(sizes)) for _ in range(r.randint(0, 7))))
        used, shards, got = 0, 0, []
        for p in parts:
            got += (shards + np.cumsum(starts(p, limit, used))).tolist()
            begun, used = Effect.of(p, limit)._short().apply(used)
            shards += begun
        assert got == sequential(sizes.tolist(), limit)
        effects = [Effect.of(p, limit)._short() for p in parts]
        while len(effects) > 1:
            i = r.randrange(len(effects) - 1)
            effects[i : i + 2] = [effects[i].then(effects[i + 1])]
        assert [effects[0].apply(u) for u in range(limit + 6)] == [Effect.of(sizes, limit).apply(u) for u in range(limit + 6)]


@pytest.mark.parametrize("ranges, limit", [(1, 10), (5, 10), (40, 10), (40, 300), (300, 1000)])
def test_next_fit(spark, ranges, limit):
    r = random.Random(ranges)
    sizes = [5, 5, 11, 1, 10, 10] + [r.randint(1, 14) for _ in range(800)]
    rows = spark.createDataFrame(list(enumerate(sizes)), "place long, size long").selectExpr("place", "place AS own", "size").repartition(3)
    got = next_fit(rows, limit, ["place", "own"], "size", ranges).orderBy("own").collect()
    assert [(r["own"], r["size"], r["shard_no"]) for r in got] == list(zip(range(len(sizes)), sizes, sequential(sizes, limit), strict=True))
    assert next_fit(rows.where("false"), limit, ["place", "own"], "size", ranges).count() == 0


def test_shards_written_and_read_in_order(spark, tmp_path):
    """Next-fit shards as lines of JSON; the scan that reads them back is one, in their order though files are split."""
    chunks = spark.range(3000).selectExpr("concat('02_LAW/x/', lpad(id div 3, 4, '0'), '.pdf') AS file", "'x' AS folder", "concat('text ', id, repeat('z', int(id % 40))) AS content", "id div 3 AS doc_ord", "int(id % 3) AS chunk_no")
    sharded = assign_shards(chunks, 40_000, ranges=7).cache()
    in_order = [r["content"] for r in chunks.orderBy("doc_ord", "chunk_no").collect()]
    sizes = [r["line_bytes"] for r in sharded.orderBy("doc_ord", "chunk_no").collect()]
    assert [r["shard_no"] for r in sharded.orderBy("doc_ord", "chunk_no").collect()] == sequential(sizes, 40_000)
    write_shards(sharded, f"{tmp_path}/s")
    described = {r["file"]: r["bytes"] for r in shard_descriptors(sharded).collect()}
    paths = [str(next((tmp_path / "s" / f"shard_no={k}").glob("part-*"))) for k in range(1, len(described) + 1)]
    assert [len(open(p, "rb").read()) for p in paths] == list(described[f"rag-index-{k:04d}.ndjson"] for k in range(1, len(paths) + 1))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
        lines = read_ndjson(spark, [*paths, f"{tmp_path}/missing/a.ndjson"])
        assert lines.select("shard_no", "block").distinct().count() > len(paths)
        assert [r["content"] for r in lines.orderBy("shard_no", "block", "line_no").collect()] == in_order
        again = numbered(lines).orderBy("shard_no", "line_no").collect()
        assert [r["content"] for r in again] == in_order and [r["line_no"] for r in again if r["shard_no"] == 2] == list(range(sum(r["shard_no"] == 2 for r in again)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_many_shards_are_one_scan(spark, tmp_path):
    for k in range(1000):
        (tmp_path / f"{k:04d} a.ndjson").write_text(json.dumps({"file": f"f{999 - k}", "content": "c"}) + "\n")
    lines = read_ndjson(spark, [f"{tmp_path}/{k:04d} a.ndjson" for k in range(999, -1, -1)] * 10)
    plan = lines._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("FileScan text") == 1 and "Union" not in plan
    assert [(r["file"], r["shard_no"]) for r in lines.where("shard_no <= 1000").orderBy("shard_no").collect()] == [(f"f{k}", k + 1) for k in range(1000)]
    assert lines.count() == 10_000


def test_bad_lines_are_dropped(spark, tmp_path):
    plan = parse_lines(spark.createDataFrame([("",)], "value string").where("value <> 'x'"))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parse_json") + plan.count("parsejson") == 1
    bad = ["", "{bad", "5", '{"file":7,"content":"c"}', '{"file":"b"}', "null", "[1]", '  {"file":"b","folder":3,"content":"c"}  ']
    assert [tuple(r)[1:] for r in parse_lines(spark.createDataFrame([(b,) for b in bad], "value string")).collect()] == [("b", None, "c")]
    (tmp_path / "a.ndjson").write_text('{"file":"x","folder":"y","content":"z"}\n\n')
    assert [tuple(r)[:3] for r in read_ndjson(spark, [f"{tmp_path}/a.ndjson", f"{tmp_path}/missing"]).collect()] == [("x", "y", "z")]


def docx(path, *paragraphs):
    body = "".join(f"<w:p><w:r><w:t>{p}</w:t></w:r></w:p>" for p in paragraphs)
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("word/document.xml", f'<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{body}</w:body></w:document>')


def test_discovery_and_extraction(spark, tmp_path):
    docx(tmp_path / "02_LAW/Italy/a b.DOCX", "space law", "Italy")
    (tmp_path / "02_LAW/node_modules").mkdir()
    docx(tmp_path / "02_LAW/node_modules/c.docx", "no")
    (tmp_path / "02_LAW/notes.txt").write_text("no")
    (tmp_path / "01_POLICY").mkdir()
    (tmp_path / "01_POLICY/bad.pdf").write_bytes(b"x")
    files = discover(spark, str(tmp_path))
    assert [r["file"] for r in files.collect()] == ["01_POLICY/bad.pdf", "02_LAW/Italy/a b.DOCX"]
    assert list_files(spark, f"{tmp_path}/none").count() == 0
    assert [len(r["sha256"]) for r in source_map(files).collect()] == [64, 64]
    got = {r["file"]: r for r in extract(files).collect()}
    assert got["02_LAW/Italy/a b.DOCX"]["text"] == "space law\n\nItaly" and not got["01_POLICY/bad.pdf"]["ok"] and got["01_POLICY/bad.pdf"]["reason"]
    assert extract_one("a.txt", b"") == (False, None, "Unsupported file type")


def test_a_slow_reader_is_ended():
    assert extract_one("a.pdf", b"", {"pdf": lambda c: time.sleep(60)}, 0.5) == (False, None, "timed out after 0.5 s")
    assert extract_one("a.pdf", b"", {"pdf": lambda c: "ok"}, 20) == (True, "ok", None)


def pdf(pages, packed=False):
    """A file with a page for each content stream: a simple font F1 and one F2 of two bytes a character."""
    objects = {
        1: b"<< /Type /Catalog /Pages 2 0 R >>", 2: b"<< /Type /Pages /Kids [%s] /Count %d /Resources << /Font << /F1 3 0 R /F2 4 0 R >> /XObject << /X 6 0 R >> >> >>"
        % (b" ".join(b"%d 0 R" % (10 + 2 * k) for k in range(len(pages))), len(pages)),
        3: b"<< /Type /Font /Subtype /Type1 /Encoding << /BaseEncoding /WinAnsiEncoding /Differences [1 /fi /Eacute /uni0416 /three] >> >>",
        4: b"<< /Type /Font /Subtype /Type0 /ToUnicode 5 0 R >>",
    }
    streams = {
        5: b"1 begincodespacerange <0000> <FFFF> endcodespacerange 1 beginbfchar <0001> <00E9> endbfchar 2 beginbfrange <0010> <0012> <0061> <0020> <0021> [<0078> <00790079>] endbfrange",
        6: b"BT /F1 9 Tf (inside a form) Tj ET",
    }
    for k, content in enumerate(pages):
        objects[10 + 2 * k] = b"<< /Type /Page /Parent 2 0 R /Contents %d 0 R >>" % (11 + 2 * k)
        streams[11 + 2 * k] = content
    out = b"%PDF-1.5\n%\xe2\xe3\n"
    if packed:
        body, head = b"", b""
        for n, o in objects.items():
            head += b"%d %d " % (n, len(body))
            body += o + b" "
        out += b"90 0 obj << /Type /ObjStm /N %d /First %d /Filter /FlateDecode >> stream\n" % (len(objects), len(head)) + zlib.compress(head + body) + b"\nendstream endobj\n"
    else:
        out += b"".join(b"%d 0 obj\n%s\nendobj\n" % (n, o) for n, o in objects.items())
    for n, data in streams.items():
        data = zlib.compress(data)
        form = b"/Subtype /Form " if n == 6 else b""
        out += b"%d 0 obj << %s/Length %d /Filter [/FlateDecode] >>\nstream\r\n%s\nendstream endobj\n" % (n, form, len(data), data)
    return out + b"trailer << /Root 1 0 R >>\n%%EOF"


@pytest.mark.parametrize("packed", [False, True])
def test_pdf(packed):
    pages = [
        b"BT /F1 12 Tf 72 700 Td (Space \\(law\\)\\041 \\\n) Tj 0 -14 Td [(off) -20 (ice) -300 (\\001nal)] TJ T* <02030433> Tj ET",
        b"q BI /W 1 ID (\x01( EI Q BT /F2 9 Tf 1 0 0 1 10 10 Tm <00010010001100120021> Tj 1 0 0 1 60 10 Tm <0020> Tj ET /X Do",
        b"",
    ]
    got = pdf_text(pdf(pages, packed)).split("\n")
    assert got == ["Space (law)! ", "office final", "ÉЖ33", "éabcyy x", "inside a form", "", ""]
    with pytest.raises(ValueError):
        pdf_text(b"x")
    with pytest.raises(ValueError):
        pdf_text(pdf(pages).replace(b"/Root 1 0 R", b"/Root 1 0 R /Encrypt 9 0 R"))
    whole = pdf(pages, packed)
    for cut in range(0, len(whole), 37):  # a damaged file gives text or an error, never a hang
        try:
            pdf_text(whole[:cut])
        except (ValueError, zlib.error, TypeError):
            pass
    assert extract_one("a.PDF", whole, timeout=20)[1].startswith("Space (law)!")


def test_a_reader_that_takes_too_much_memory_is_ended():
    ok, text, reason = extract_one("a.pdf", b"", {"pdf": lambda c: str(len(bytearray(1 << 30)))}, 20, 64)
    assert (ok, text) == (False, None) and "memory" in reason
    assert extract_one("a.pdf", b"", {"pdf": lambda c: str(len(bytearray(1 << 20)))}, 20, 64) == (True, str(1 << 20), None)


@pytest.mark.parametrize("seed", range(3))
def test_overlaps(seed):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("ab") if seed else "a" for _ in range(n))
    for _ in range(200):
        text, n = word(r.randint(0, 60)), r.randint(0, 40)
        chunk = text[len(text) - min(n, len(text)) :] + word(r.randint(0, 30))
        sizes = [k for k in range(20, min(1000, len(text), len(chunk)) + 1) if text.endswith(chunk[:k])]
        assert join_overlapping(text, chunk) == (text + chunk[max(sizes) :] if sizes else f"{text} {chunk}" if text and chunk else text + chunk)


def test_start_and_end(spark, tmp_path):
    docx(tmp_path / "src/02_LAW/Italy/a.docx", "The space law of Italy")
    store = Store(spark, f"file://{tmp_path}/store")
    service = Service(store, Rebuild(store))
    server, behind = start(service, lambda: discover(spark, f"{tmp_path}/src"), "127.0.0.1", 0)
    c = HTTPConnection(*server.server_address, timeout=60)
    c.request("GET", "/health")
    assert c.getresponse().status == 200
    behind.join(120)
    assert service.indexed_chunks == 1 and service.mode == "final"
    server.shutdown()
    server.server_close()


def test_http(spark, tmp_path):
    docx(tmp_path / "src/02_LAW/Italy/a.docx", "The space law of Italy")
    store = Store(spark, f"file://{tmp_path}/store")
    service = Service(store, Rebuild(store), "secret")
    server = serve(service, lambda: discover(spark, f"{tmp_path}/src"), "127.0.0.1", 0)
    threading.Thread(target=server.serve_forever, daemon=True).start()

    def call(method, path, body=None, token=""):
        c = HTTPConnection(*server.server_address, timeout=60)
        c.request(method, path, body if body is None or isinstance(body, str) else json.dumps(body), {"Authorization": token})
        r = c.getresponse()
        return r.status, json.loads(r.read())

    assert call("GET", "/health")[1]["ready"] is False and call("GET", "/x")[0] == 404 and call("POST", "/x")[0] == 404
    assert call("POST", "/rag/search", "[1]")[0] == 400 and call("POST", "/rag/search", {"query": "a"})[0] == 503
    assert call("POST", "/rag/rebuild")[0] == 401 and call("POST", "/rag/rebuild", {}, "Bearer secret")[0] == 202
    for _ in range(120):
        if service.indexed_chunks:
            break
        time.sleep(0.5)
    code, body = call("POST", "/rag/search", {"query": "space law"})
    assert code == 200 and [h["file"] for h in body["results"]] == ["02_LAW/Italy/a.docx"]
    assert call("POST", "/rag/document", {"file": "02_LAW/Italy/a.docx"})[1]["text"] == "The space law of Italy"
    server.shutdown()


def test_published_shards_are_bounded_listed_and_needed(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    store.shard_mb = 1000 / 2**20
    text = "space law of Italy " * 300
    docx(tmp_path / "src/02_LAW/Italy/a.docx", text)
    docx(tmp_path / "src/02_LAW/Spain/b.docx", text)
    plan = Rebuild(store, ChunkSize(300, 30))
    report = plan.run(discover(spark, f"{tmp_path}/src"))
    manifest = store.manifest()
    folder = tmp_path / "store"
    assert len(manifest["shards"]) > 2 and sum(s["chunks"] for s in manifest["shards"]) == report["totalChunks"] == store.chunks(manifest).count()
    sizes, numbers = [], []
    for s in manifest["shards"]:
        assert (folder / s["file"]).stat().st_size == s["bytes"]
        lines = [r["value"] for r in to_lines(spark.read.parquet(f"file://{folder}/{s['file']}")).collect()]
        assert sum(len(v.encode()) + 1 for v in lines) == s["lineBytes"] <= 1000
        sizes += [len(v.encode()) + 1 for v in lines]
        numbers += [s["number"]] * len(lines)
    assert numbers == sequential(sizes, 1000)
    store.export(manifest, f"{tmp_path}/lines")
    assert sorted(int(p.name.split("=")[1]) for p in (tmp_path / "lines").glob("shard_no=*")) == list(range(1, len(manifest["shards"]) + 1))
    # A file that isn't listed isn't read; a listed one that is gone is an error, and what was open stays open.
    service = Service(store, plan)
    assert service.load() and service.status()["indexLoadedAt"] and service.status()["lastPublishedAt"]
    (folder / manifest["shards"][0]["file"]).with_name("left-over.parquet").write_bytes((folder / manifest["shards"][0]["file"]).read_bytes())
    assert store.chunks(manifest).count() == report["totalChunks"]
    (folder / manifest["shards"][0]["file"]).unlink()
    with pytest.raises(ValueError, match="missing"):
        Service(store, plan).load()
    assert service.mode == "final" and service.indexed_chunks == report["totalChunks"]


def test_rebuild_service_and_stream(spark, tmp_path):
    root, store = tmp_path / "src", Store(spark, f"file://{tmp_path}/store")
    docx(root / "02_LAW/Italy/a.docx", "The space law of Italy and the law of space")
    docx(root / "02_LAW/Spain/b.docx", "alpha beta gamma")
    plan = Rebuild(store)
    service = Service(store, plan, "secret")
    assert service.search({"query": "space law"})[0] == 503 and not service.load()
    first = plan.run(discover(spark, str(root)))
    assert (first["changedFiles"], first["indexedFiles"], first["noChanges"]) == (2, 2, False) and service.load()
    assert plan.run(discover(spark, str(root)))["noChanges"]
    code, body = service.search({"query": "Italy space law", "topK": "3x", "alternateQueries": ["law space"]})
    assert code == 200 and body["topK"] == 3 and body["results"][0]["file"] == "02_LAW/Italy/a.docx" and body["results"][0]["matchedQueries"] == ["Italy space law", "law space"]
    assert (body["resultCount"], body["alternateQueries"], body["indexMode"], body["rebuildInProgress"]) == (1, ["law space"], "final", False) and body["indexedChunks"] == first["totalChunks"]
    assert service.search({"query": " "})[0] == 400
    code, page = service.document({"file": "02_LAW\\Italy\\a.docx", "limit": 5})
    assert code == 200 and page["text"].startswith("The space law") and page["nextOffset"] is None and page["totalCharacters"] == len(page["text"])
    assert service.document({"file": "nope"})[0] == 404 and service.document({})[0] == 400
    docx(root / "02_LAW/Spain/b.docx", "alpha beta delta")
    docx(root / "04_FUNDING/c.docx", "new text here")
    (root / "02_LAW/Italy/a.docx").unlink()
    assert service.rebuild("Bearer wrong", None)[0] == 401 and Service(store, plan).rebuild("x", None)[0] == 503
    code, report = service.rebuild("Bearer secret", discover(spark, str(root)))
    assert code == 202 and report["deletedFiles"] == 1 and report["changedFiles"] == 2 and report["totalChunks"] == 2
    assert sorted(r["file"] for r in service.chunks().select("file").collect()) == ["02_LAW/Spain/b.docx", "04_FUNDING/c.docx"]
    docx(root / "04_FUNDING/d.docx", "more text here")
    plan.run(discover(spark, str(root)), checkpoint_every=1)
    assert store.manifest("checkpoint") is None and store.manifest()["totalChunks"] == 3
    # An interrupted rebuild: the second batch dies, and the next run takes the first one over.
    for k in range(6):
        docx(root / f"05_COMPANIES/x/{k}.docx", f"company text number {k}")
    (root / "05_COMPANIES/x/bad.docx").write_bytes(b"no archive")
    batch, left = plan._batch, [1]

    def dies(*a):
        if not left:
            raise OSError("lost")
        left.pop()
        return batch(*a)

    plan._batch = dies
    with pytest.raises(OSError):
        plan.run(discover(spark, str(root)), checkpoint_every=2)
    plan._batch = batch
    done = store.manifest("checkpoint")["report"]
    assert 0 < done["processedChangedFiles"] < 7
    resumed = plan.run(discover(spark, str(root)))
    assert resumed["changedFiles"] == 7 - done["processedChangedFiles"] and resumed["totalChunks"] == 9 and store.manifest("checkpoint") is None
    failed = {r["file"]: r["reason"] for r in store.states(store.manifest()).where("status = 'skipped'").collect()}
    assert list(failed) == ["05_COMPANIES/x/bad.docx"] and failed["05_COMPANIES/x/bad.docx"]
    assert [f["file"] for r in (done, resumed) for f in r["failures"]] == ["05_COMPANIES/x/bad.docx"]
    for f in root.rglob("*.docx"):
        f.unlink()
    with pytest.raises(ValueError):
        plan.run(discover(spark, str(root)))
    with pytest.raises(ValueError):
        validate({"shards": [{"file": 3}]})
    spark.createDataFrame([("a/b.pdf", "one two"), ("a/c.pdf", None)], "file string, text string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("file string, text string").parquet(f"{tmp_path}/in")
    ingest_stream(stream, f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination()
    assert [r["content_norm"] for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["one two"]


def files_of(folder):
    return {str(p.relative_to(folder)): p.stat().st_size for p in folder.rglob("commits/*/chunks/*/*.parquet")}


def test_checkpoints_append_and_old_snapshots_go(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store", grace=0)
    store.shard_mb = 4000 / 2**20
    r = random.Random(1)
    for k in range(20):
        docx(tmp_path / f"src/02_LAW/x/{k:02d}.docx", " ".join(r.choice(["space", "law", "alpha", f"n{r.randint(0, 999)}"]) for _ in range(600)))
    plan, written, publish = Rebuild(store, ChunkSize(400, 40)), [], store.publish

    def counted(*args, **kwargs):
        before = files_of(tmp_path / "store")
        made = publish(*args, **kwargs)
        after = files_of(tmp_path / "store")
        written.append((made["type"], sum(n for f, n in after.items() if f not in before), set(before) - set(after)))
        return made

    store.publish = counted
    report = plan.run(discover(spark, f"{tmp_path}/src"), checkpoint_every=2)
    manifest = store.manifest()
    index = sum(s["bytes"] for s in manifest["shards"])
    # Ten commits, each with its own files only, and none of them written twice.
    assert [kind for kind, *_ in written] == ["checkpoint"] * 9 + ["final"] and sum(n for _, n, _ in written) <= 1.2 * index
    assert files_of(tmp_path / "store").keys() == {s["file"] for s in manifest["shards"]} and [s["number"] for s in manifest["shards"]] == list(range(1, len(manifest["shards"]) + 1))
    assert store.chunks(manifest).count() == report["totalChunks"] and len(list((tmp_path / "store/snapshots").iterdir())) == 1
    # One changed file: its shards are written anew, the others stay; the snapshot before stays open for its readers.
    docx(tmp_path / "src/02_LAW/x/07.docx", "another text")
    old = store.chunks(manifest)
    report = plan.run(discover(spark, f"{tmp_path}/src"))
    now = store.manifest()
    kept = {s["file"] for s in now["shards"]} & {s["file"] for s in manifest["shards"]}
    assert len(manifest["shards"]) - len(kept) <= 8 and written[-1][1] < index / 2 and not written[-1][2]
    assert old.count() > store.chunks(now).count() == report["totalChunks"] and report["copiedChunks"] + 1 == report["totalChunks"]
    assert [r["content"] for r in store.chunks(now).where("file = '02_LAW/x/07.docx'").collect()] == ["another text"]
    # Nothing that no pointer reaches is left after the next one.
    docx(tmp_path / "src/02_LAW/x/07.docx", "a third text")
    plan.run(discover(spark, f"{tmp_path}/src"))
    reached = {s["file"] for s in store.manifest()["shards"]} | {s["file"] for s in now["shards"]}
    assert {f.split("/")[1] for f in files_of(tmp_path / "store")} == {f.split("/")[1] for f in reached}
    assert len(list((tmp_path / "store/snapshots").iterdir())) == 2


def files_read(df):
    """Files that a scan read, by Spark's own metric."""
    plan = df.select("content")._jdf.queryExecution().executedPlan()
    df.sparkSession._jvm.scala.Predef  # the gateway's package is loaded
    plan.executeCollect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numFiles").value() for k in range(leaves.size()) if leaves.apply(k).metrics().contains("numFiles"))


def test_searches_score_only_shards_that_may_match(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    store.shard_mb = 3000 / 2**20
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6))
    texts = [(f"0{1 + k % 5}_X/x/{k:03d}.pdf", " ".join(word() for _ in range(150)) + f" the law état-{k % 7} ab") for k in range(160)]
    docs = spark.createDataFrame(texts, "file string, text string").coalesce(2)
    states = docs.selectExpr("file", "'' AS sha256", "1L AS size", "'indexed' AS status", "CAST(NULL AS STRING) AS reason", "1L AS chunks")
    manifest = store.publish(searchable(chunk_documents(docs)), states, {"totalChunks": 160, "report": {}, "streams": {}})
    service = Service(store, Rebuild(store))
    assert service.load() and len(manifest["shards"]) > 32
    whole = service.chunks()
    rare = [w for t in (3, 77) for w in texts[t][1].split()[5:7]]
    for asked, few in [
        ([f"{rare[0]} {rare[1]}"], True), ([f"{rare[0][:5]} {rare[1][1:]}", f"{rare[2]} nothing"], True), (["the law"], False), ([f"{rare[0]} law"], False), (["the"], True), (["the the"], False), (["etat-3 the"], False),
        ([f"{rare[0]} {rare[0]}"], True), (["ab cd"], True), ([], True),
    ]:
        pruned = service.scored_chunks(asked)
        columns = ["file", "score", "matched_terms"]
        assert [tuple(x) for x in search(pruned, asked, 50).select(*columns).collect()] == [tuple(x) for x in search(whole, asked, 50).select(*columns).collect()]
        if few:
            assert pruned.count() * 10 <= whole.count() and files_read(pruned) * 10 <= len(manifest["shards"])
    assert service.search({"query": f"{rare[0]} {rare[1]}"})[1]["results"][0]["file"] == texts[3][0]


def test_pages_open_few_shards_and_searches_list_nothing(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    store.shard_mb = 1500 / 2**20
    texts = spark.range(400).selectExpr("concat('02_LAW/x/', lpad(id, 4, '0'), '.pdf') AS file", "concat('alpha beta number ', id, repeat(' more text', 110)) AS text")
    rows = searchable(chunk_documents(texts))
    manifest = store.publish(rows, texts.selectExpr("file", "sha2(text, 256) AS sha256", "1L AS size", "'indexed' AS status", "CAST(NULL AS STRING) AS reason", "1L AS chunks"), {"totalChunks": rows.count(), "report": {}, "streams": {}})
    assert len(manifest["shards"]) >= 400
    for name in ("02_LAW/x/0000.pdf", "02_LAW/x/0123.pdf", "02_LAW/x/0399.pdf"):
        own = store.chunks_of(manifest, store.chunks(manifest), name)
        assert 1 <= files_read(own) <= 2
    service = Service(store, Rebuild(store))
    assert service.load()
    listed = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    first = service.search({"query": "alpha beta"})[1]["results"]
    before = listed.getCount()
    assert service.search({"query": "alpha beta"})[1]["results"] == first and listed.getCount() == before
    assert [h["file"] for h in first[:2]] == ["02_LAW/x/0000.pdf", "02_LAW/x/0001.pdf"]
    page = service.document({"file": "02_LAW/x/0123.pdf"})[1]
    assert page["text"].startswith("alpha beta number 123 more") and listed.getCount() - before <= 2
    assert service.document({"file": "02_LAW/x/none.pdf"})[0] == 404 and service.load() and listed.getCount() - before <= 4


def test_a_stream_into_the_index(spark, tmp_path):
    """Stopped and started again, and a batch run twice: the index of one run."""
    store = Store(spark, f"file://{tmp_path}/store", grace=0)
    docs = lambda a, b: spark.range(a, b).selectExpr("concat('02_LAW/x/', lpad(id, 3, '0'), '.pdf') AS file", "concat('alpha beta ', id, repeat(' text', int(id * 20))) AS text")
    schema = "file string, text string"
    for part, (a, b) in enumerate([(0, 10), (10, 25)]):
        docs(a, b).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        ingest_into(stream, store, f"{tmp_path}/ck", "texts").awaitTermination()
        assert store.manifest()["streams"] == {"texts": part}
    # A file that comes again, one without a text and one without a name; and the same batch once more.
    more = spark.createDataFrame([("02_LAW/x/003.pdf", "gamma delta"), ("02_LAW/x/999.pdf", None), (None, "lost")], schema)
    assert commit_batch(more, 2, store, "texts") and not commit_batch(more, 2, store, "texts") and not commit_batch(docs(0, 3), 1, store, "texts")
    want = searchable(chunk_documents(docs(0, 25).where("file <> '02_LAW/x/003.pdf'").unionByName(more.where("file IS NOT NULL"))))
    columns = ["file", "folder", "chunk_no", "start", "content", "content_norm"]
    got = sorted(tuple(r) for r in store.chunks(store.manifest()).select(*columns).collect())
    assert got == sorted(tuple(r) for r in want.select(*columns).collect())
    service = Service(store, Rebuild(store))
    assert service.load() and service.indexed_chunks == len(got)
    assert [h["file"] for h in service.search({"query": "gamma delta"})[1]["results"]] == ["02_LAW/x/003.pdf"]
    states = {r["file"]: r["chunks"] for r in store.states(store.manifest()).collect()}
    assert len(states) == 26 and states["02_LAW/x/999.pdf"] == 0 and sum(states.values()) == len(got)


def test_signatures_hash_stretches_and_hold_few_bitmaps(spark):
    text = "".join(chr(97 + k * k % 23) for k in range(3 * signatures_.STRETCH + 5)) + "é"
    tracemalloc.start()
    found = set()
    for part in signatures_._hashed(text):
        found.update(np.unique(part).tolist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * signatures_.STRETCH + (4 << 20)
    assert all(set(signatures_.places(text[at : at + 9]).tolist()) <= found for at in range(signatures_.STRETCH - 9, signatures_.STRETCH + 3))
    # More shards than a task holds, in turn.
    names = [f"s{k % (signatures_.OPEN + 9)}" for k in range(3 * signatures_.OPEN)]
    rows = spark.createDataFrame([(n, f"text {k} of {n}") for k, n in enumerate(names)], "name string, content_norm string").repartition(1)
    made: dict[str, set] = {}
    for r in signatures_.signatures(rows).collect():
        bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        made.setdefault(r["name"], set()).update((np.flatnonzero(bits) + r["page"] * signatures_.PAGE).tolist())
    assert set(made) == set(names)
    for k, n in enumerate(names):
        assert set(signatures_.places(f"text {k} of {n}").tolist()) <= made[n]


def test_a_rebuild_moves_no_more_than_it_works_off(spark, tmp_path):
    class Watched(Store):
        seen: list = []

        def commit(self, chunks, after=0):
            self.seen.append((list(chunks.columns), chunks._jdf.queryExecution().withCachedData().toString()))
            return super().commit(chunks, after)

    rows = [(f"02_LAW/{k}.txt", f"/{k}", 300, (f"ÉTÉ {k} " * 400).encode()) for k in range(12)]
    files = lambda rs: spark.createDataFrame(rs, "file string, absolute_path string, size long, content binary")
    store = Watched(spark, f"{tmp_path}/index")
    plan = Rebuild(store, readers={"txt": bytes.decode}, timeout=None)
    plan.run(files(rows), 5)
    changed = [*rows[:6], *[(f, p, s, c + b" later") for f, p, s, c in rows[6:9]]]
    report = plan.run(files(changed), 2)
    assert (report["changedFiles"], report["deletedFiles"], report["unchangedFiles"]) == (3, 3, 6)
    assert len(store.seen) > 3 and not any("content_norm" in columns for columns, _ in store.seen)
    chunks = store.chunks(store.manifest()).collect()
    assert {r["file"] for r in chunks} == {r[0] for r in changed} and all(r["content_norm"] == T.normalise_text(r["content"]) for r in chunks)
    assert sum(r["content"].endswith("later") for r in chunks) >= 3


def test_extraction_passes_on_few_texts_at_a_time(spark):
    files = spark.createDataFrame([(f"{k}.txt", b"x" * k) for k in range(100)] + [("no.bin", b"1"), ("null.txt", None)], "file string, content binary").repartition(1)
    read = lambda content: content.decode() if len(content) != 7 else 1 / 0
    made = extract(files, {"txt": read})
    got = {r["file"]: (r["ok"], r["text"], r["reason"]) for r in made.collect()}
    assert got == {f"{k}.txt": (True, "x" * k, None) if k != 7 else (False, None, "division by zero") for k in range(100)} | {"no.bin": (False, None, "Unsupported file type"), "null.txt": (True, "", None)}
    assert "MapInPandas" not in made._jdf.queryExecution().toString()


def test_lines_are_numbered_where_they_were_read(spark, tmp_path):
    line = lambda k: '{"file":"f","folder":"d","content":"c%d"}' % k
    (tmp_path / "a").write_text("\n".join(line(k) for k in range(500)))
    (tmp_path / "b").write_text("\n".join("bad" if k % 3 == 1 else line(k) for k in range(500)))
    wanted = [(1, k, f"c{k}") for k in range(500)] + [(2, n, f"c{k}") for n, k in enumerate(k for k in range(500) if k % 3 != 1)]
    conf, most = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("4000", most):
        spark.conf.set(conf, size)
        try:
            made = numbered(read_ndjson(spark, [f"{tmp_path}/a", f"{tmp_path}/b"]))
            assert sorted((r["shard_no"], r["line_no"], r["content"]) for r in made.collect()) == wanted
        finally:
            spark.conf.set(conf, most)
    one = numbered(read_ndjson(spark, [f"{tmp_path}/a"]))
    assert "Union" in one._jdf.queryExecution().optimizedPlan().toString()


def test_documents_are_joined_in_a_stream(spark):
    words = [" ".join(f"w{(k * 7919 + j * j) % 9973}" for j in range(40 * k)) for k in range(60)]
    docs = spark.createDataFrame([(f"a/{k}.txt", t) for k, t in enumerate(words)], "file string, text string")
    made = document.reassemble(chunk_documents(docs, ChunkSize(200, 60)).repartition(3, "content"))
    got = {r["file"]: (r["chunk_count"], r["text"]) for r in made.collect()}
    for k, text in enumerate(words):
        chunks = model_chunks(text, 200, 140)
        joined = ""
        for c in chunks:
            joined = document.join_overlapping(joined, c[-1] if isinstance(c, tuple) else c)
        assert got.get(f"a/{k}.txt", (0, "")) == (len(chunks), joined)
    assert "FlatMapGroupsInPandas" not in made._jdf.queryExecution().toString()
