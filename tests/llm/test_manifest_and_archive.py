"""Merkle manifest and WARC archives against plain Python."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from pathlib import Path

import compare
import pytest
from pyspark.sql import functions as F

from tabloom.llm import common, merkle, queries, warc

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    """All levels of a tree over a list of digests."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def path_of(levels, at):
    """(siblings before, siblings behind) level by level."""
    out = []
    for nodes in levels[:-1]:
        run = at // 3 * 3
        out.append(("".join(nodes[run:at]), "".join(nodes[at + 1 : run + 3])))
        at //= 3
    return out


def expected(rows, tampered):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row."""
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row), leaf_of(tampered(row))))
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: levels_of([x[2] for x in sorted(trees[s])]) for s in order}
    top = levels_of([levels[s][-1][0] for s in order])
    out = []
    for place, source in enumerate(order):
        for at, (known, doc_id, leaf, now) in enumerate(sorted(trees[source])):
            path = path_of(levels[source], at) + path_of(top, place)
            for before, behind in path:
                now = sha(before + now + behind)
            proof = sha("".join(a + b for a, b in path))
            out.append((doc_id if known else None, leaf, levels[source][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return out


def chosen(row):
    cut = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None
    return (*row[:4], row[4].replace("\n", "") if cut else row[4])


def audited(df, levels=merkle.LEVELS):
    when = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = merkle.audit(df, COLUMNS, lambda t: F.replace(t, F.lit("\n"), F.lit("")), when, levels=levels)
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return [tuple(r[n] for n in names) for r in found.collect()]


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest(spark, levels):
    """A hot source, sources of all small sizes, NULLs, repeated rows, odd texts, columns with clashing names."""
    draw = random.Random(levels)
    rows = [(i, "hot", "en", i, f"line {i}\nline") for i in range(90)]
    rows += [(1000 * n + i, f"s{n}", None, i, draw.choice(["", None, "é\n\n漢", "\n", "a" * 20_000])) for n in range(1, 15) for i in range(n)]
    rows += [(5, None, "en", None, "x\ny"), (None, None, None, None, None), (None, "hot", None, None, "a\nb")]
    rows += [(7, "Ā", "en", 1, "same\n"), (7, "Ā", "en", 1, "same\n"), (7, "Ā", "en", 1, "other"), (9, "", None, 1, "z")]
    draw.shuffle(rows)
    ddl = "doc_id long, source string, lang string, n_chars long, text string, key string, tree string, position int"
    df = spark.createDataFrame([(*r, "k", "t", 3) for r in rows], ddl).repartition(5)
    assert sorted(map(str, audited(df, levels))) == sorted(map(str, expected(rows, chosen)))


def test_manifest_shapes(spark, monkeypatch):
    ddl = "doc_id long, source string, lang string, n_chars long, text string"
    empty = spark.createDataFrame([], ddl)
    assert audited(empty) == []
    assert merkle.build(empty, COLUMNS).root is None
    one = [(3, "a", None, 1, "only\n")]
    assert audited(spark.createDataFrame(one, ddl)) == expected(one, chosen)
    found = merkle.build(spark.createDataFrame(one, ddl), COLUMNS)
    assert found.root == leaf_of(one[0]) and found.sources.count() == 1


@pytest.mark.parametrize("count", [1, 2, 3, 8, 9, 10, 26, 27, 28, 80, 81, 82, 100])
@pytest.mark.parametrize("levels", [1, 2, 3])
def test_blocks_meet_the_definition(count, levels):
    """Sweeps over single blocks against the whole tree."""
    leaves = [sha(str(i)) for i in range(count)]
    whole = levels_of(leaves)
    width = 3**levels
    nodes = [n for b in range(0, count, width) for n in merkle.block_nodes("t", b // width, enumerate(leaves[b : b + width], b), levels)]
    for _, _, end, level, own, *_ in nodes:
        assert level >= len(whole) or own == whole[level][end // 3**level]
    tops = [n for n in nodes if n[6]]
    assert len(tops) == -(-count // width)
    if count < width:
        assert [n[4] for n in tops] == whole[-1] and tops[0][7]


def test_fold_finds_any_change():
    leaves = [sha(str(i)) for i in range(11)]
    rows = [("t", 0, i, 0, None) for i in range(11)]
    rows += [("t", 0, n[2], n[3], n[5]) for n in merkle.block_nodes("t", 0, enumerate(leaves), 8)]
    rows.sort(key=lambda r: (-r[2], -r[3]))
    root = levels_of(leaves)[-1][0]
    proofs = {at: proof for at, proof, _ in merkle.block_proofs("", rows)}
    assert sorted(proofs) == list(range(11))
    for at, proof in proofs.items():
        assert merkle.fold(leaves[at], proof)[0] == root
        assert merkle.fold(leaves[at - 1], proof)[0] != root


# --- archives


def digest_rows(pages, min_bytes=0):
    """page_id, payload_bytes, payload_digest, record_type, refers_to by the rules."""
    first = {}
    for page_id, _, html in pages:
        content = (html or "").encode()
        first[content] = min(first.get(content, page_id), page_id)
    out = []
    for page_id, _, html in pages:
        content = (html or "").encode()
        again = len(content) >= min_bytes and first[content] != page_id
        name = base64.b32encode(hashlib.sha1(content).digest()).decode()
        out.append((page_id, len(content), name, "revisit" if again else "response", first[content] if again else None))
    return out


def odd_pages():
    draw = random.Random(5)
    pages = [(i, f"http://h/{i}", "<p>same</p>") for i in range(40)]
    pages += [(100, None, None), (101, "http://ü/ a\r\nX: y", ""), (102, "u", "\r\n\r\n"), (103, "u", "\r\n"), (104, "u", "x" * 3_000_000)]
    pages += [(105, "u", "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"), (106, "u", "é漢\U0001f600\x00\n\r")]
    pages += [(200 + i, "v", "".join(draw.choices(["\r", "\n", "\r\n", "a", "\r\n\r\n"], k=draw.randint(0, 12)))) for i in range(200)]
    return pages


@pytest.mark.parametrize("small", [200_000, 1])
@pytest.mark.parametrize("min_bytes", [0, 12])
def test_archive(spark, tmp_path, monkeypatch, small, min_bytes):
    monkeypatch.setattr(common, "SMALL_ROWS", small)
    pages = odd_pages()
    df = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, content string")
    path = str(tmp_path / "archive")
    warc.write_warc(df.repartition(4), path, min_bytes=min_bytes)
    captures = warc.assemble(warc.read_records(spark, path)).collect()
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["referred"] and r["referred"]["page_id"]) for r in captures]
    assert sorted(got, key=str) == sorted(digest_rows(pages, min_bytes), key=str)
    html = {i: (h or "").encode() for i, _, h in pages}
    for row in captures:
        assert row["digest_ok"] and [r["type"] for r in row["request"]] == ["request"] and len(row["metadata"]) == 1
        assert row["payload"] is None if row["record_type"] == "revisit" else bytes(row["payload"]) == html[row["page_id"]]
        assert not re.search(r"[\s\x7f-]", row["target_uri"] or "")


def test_archive_files(spark, tmp_path):
    """The files, read without the library: whole records, unique ids, links that exist."""
    pages = odd_pages()
    path = tmp_path / "archive"
    warc.write_warc(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3), str(path))
    ids, links, kinds = [], [], []
    for file in path.glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = [x.split(": ", 1) for x in head.decode().split("\r\n")[1:]]
            named = dict(fields)
            size = int(named["Content-Length"])
            assert head.startswith(b"WARC/1.0\r\n") and rest[size : size + 4] == b"\r\n\r\n"
            ids.append(named["WARC-Record-ID"])
            kinds.append(named["WARC-Type"])
            links += [named[n] for n in ("WARC-Concurrent-To", "WARC-Refers-To") if n in named]
            data = rest[size + 4 :]
    assert len(set(ids)) == len(ids) and set(links) <= set(ids)
    assert kinds.count("request") == kinds.count("metadata") == len(pages)


def test_archive_repeated_rows_and_null_ids(spark, tmp_path):
    rows = [(1, "u", "a"), (1, "u", "a"), (None, "u", "a"), (None, None, "b"), (2, "u", "c")]
    path = str(tmp_path / "archive")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    captures = warc.assemble(warc.read_records(spark, path, with_payload=False))
    got = [(r["page_id"], r["record_type"], r["referred"] and r["referred"]["page_id"]) for r in captures.collect()]
    want = [(1, "response", None), (1, "revisit", 1), (None, "revisit", 1), (None, "response", None), (2, "response", None)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_archive_empty(spark, tmp_path):
    path = str(tmp_path / "archive")
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.assemble(warc.read_records(spark, path)).count() == 0


def foreign(records):
    out = b""
    for fields, block in records:
        head = "\r\n".join(["WARC/1.0", *[f"{a}: {b}" for a, b in fields], f"Content-Length: {len(block)}"])
        out += gzip.compress(head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n")
    return out


def test_archive_of_others(spark, tmp_path):
    """A member for each record, links stated by the response, a revisit of what is in no archive."""
    http = b"HTTP/1.1 200 OK\r\n\r\n"
    records = [
        ([("WARC-Type", "request"), ("WARC-Record-ID", "<urn:uuid:q>")], b"GET / HTTP/1.1\r\n\r\n"),
        ([("WARC-Type", "response"), ("WARC-Record-ID", "<urn:uuid:r>"), ("WARC-Concurrent-To", "<urn:uuid:q>"),
          ("WARC-Concurrent-To", "<urn:uuid:m>"), ("Content-Type", "application/http;msgtype=response")], http + b"body"),
        ([("WARC-Type", "metadata"), ("WARC-Record-ID", "<urn:uuid:m>"), ("Content-Type", "application/warc-fields")], b"via: x\r\n"),
        ([("WARC-Type", "revisit"), ("WARC-Record-ID", "<urn:uuid:v>"), ("WARC-Refers-To", "<urn:uuid:gone>"),
          ("Content-Type", "application/http;msgtype=response")], http),
    ]
    Path(tmp_path / "a.warc.gz").write_bytes(foreign(records))
    rows = {r["capture_id"]: r for r in warc.assemble(warc.read_records(spark, str(tmp_path))).collect()}
    assert [x["record_id"] for x in rows["r"]["request"]] == ["q"] and [x["record_id"] for x in rows["r"]["metadata"]] == ["m"]
    assert bytes(rows["r"]["payload"]) == b"body" and rows["r"]["page_id"] is None
    assert rows["v"]["referred"] is None and rows["v"]["payload_bytes"] is None


def test_archive_cut_short(spark, tmp_path):
    whole = foreign([([("WARC-Type", "resource"), ("WARC-Record-ID", "<urn:uuid:x>")], b"0123456789")])
    Path(tmp_path / "a.warc.gz").write_bytes(gzip.compress(gzip.decompress(whole)[:-9]))
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_records(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("name", ["op11_merkle", "op12_warc"])
def test_twins(spark, name):
    assert compare.compare(spark, compare.database(SF_DIR), name, SF_DIR) is None
    assert name in queries.ORACLES
