"""Operators on single documents against the libraries or plain Python."""

import bisect
import hashlib
import itertools
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tabloom.llm import (
    html_extract,
    language_id,
    license_scan,
    packing,
    quality_rules,
    sentencepiece_codec,
)
from tabloom.llm.common import ChunkTable, WordHashes, small


#: Models that are slow to load, for the tests on many examples.
_CACHE: dict = {}


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def test_codec_equals_library(spark, documents, empty, tricky, vocabulary_path):
    model = vocabulary_path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    clashing = documents.withColumnRenamed("source", "ids")
    out = sentencepiece_codec.decode(sentencepiece_codec.encode(clashing, model), model)
    assert out.columns == ["doc_id", "text", "lang", "n_chars", "ids", "decoded"]
    found = {r["doc_id"]: (r["ids"], r["decoded"]) for r in out.collect()}
    for doc_id, text, *_ in tricky:
        ids = library.encode(text or "")
        assert found[doc_id] == (ids, library.decode(ids) if ids else "")
    assert sentencepiece_codec.encode(empty, model).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab ▁\n\té漢\U0001f600<s>'.0"), max_size=40))
def test_codec_on_any_text(text):
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    table = _CACHE.get("table") or _CACHE.setdefault("table", sentencepiece_codec._table(model))
    library = _CACHE.get("library") or _CACHE.setdefault("library", sentencepiece_codec._load(model))
    ids, bounds = table.ids([sentencepiece_codec.split_chunks(text), []])
    assert ids.tolist() == library.encode(text)
    assert bounds.tolist() == [0, len(ids), len(ids)]


def test_codec_refuses_pieces_across_markers():
    class Model:
        def get_piece_size(self):
            return 1

        def id_to_piece(self, i):
            return "a▁b"

    with pytest.raises(ValueError, match="marker"):
        sentencepiece_codec.check_model(Model())


def test_chunk_table_starts_anew():
    table = ChunkTable(lambda chunks: [[len(c)] * len(c) for c in chunks], limit=2)
    for _ in range(3):
        ids, bounds = table.ids([["a", "bb", "a"], [], ["ccc", ""]])
        assert ids.tolist() == [1, 2, 2, 1, 3, 3, 3] and bounds.tolist() == [0, 4, 4, 7]


def test_small_batches_keep_rows():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"x": ["a" * 100] * 50})
    parts = list(small([batch, batch.slice(0, 0)], rows=7, size=1000))
    assert sum(p.num_rows for p in parts) == 50 and max(p.num_rows for p in parts) <= 7


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZéÀßµ漢.,!'#-0<|>ſİ́ "), min_size=1, max_size=12), max_size=5))
def test_word_encoder_equals_tokenizer(words):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = _CACHE.get("encoder") or _CACHE.setdefault("encoder", packing.word_encoder(path))
    coder = _CACHE.get("coder") or _CACHE.setdefault("coder", Tokenizer.from_file(path))
    text = " ".join([*words, "<|endoftext|>x"])
    parts = encoder(text.encode().split())
    assert [i for p in parts for i in p] == coder.encode(text, add_special_tokens=False).ids


def test_packing(spark, documents, empty, tricky, vocabulary_path):
    path = vocabulary_path("word_bpe_49k.json")
    coder = Tokenizer.from_file(path)
    pieces = packing.tokenize(documents, path, capacity=256, with_ids=True)
    rows = packing.pack(pieces, capacity=256).collect()
    want = {}
    for doc_id, text, *_ in tricky:
        ids = coder.encode(text or "", add_special_tokens=False).ids + [1]
        for piece, at in enumerate(range(0, len(ids), 256)):
            own = ids[at : at + 256]
            crc = zlib.crc32(np.array(own, dtype="<u4").tobytes())
            want[doc_id, piece] = (at, len(own), crc, own)
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"], r["ids"]) for r in rows}
    assert got == want and len(rows) == len(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        ends = [o + n for o, n in own]
        assert [o for o, _ in own] == [0, *ends[:-1]] and ends[-1] <= 256
    assert len(bins) <= -(-sum(v[1] for v in want.values()) // 256) + 4
    assert packing.pack(packing.tokenize(empty, path)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), min_size=1, max_size=12))
def test_plan_uses_every_piece_once(histogram):
    plan = packing.plan_bins(dict(histogram), 40)
    fill, used = Counter(), Counter()
    for length, first, end, sequence, each, offset in plan:
        used[length] += end - first
        for slot in range(end - first):
            fill[sequence + slot // each] += length
    assert used == Counter(histogram) and max(fill.values()) <= 40
    for length, room in ((7, 40), (40, 40)):
        chosen = packing.fullest(histogram, sorted(histogram, reverse=True), room - length)
        assert sum(n * c for n, c in chosen.items()) == _best(histogram, room - length)


def _best(histogram, room):
    sums = {0}
    for n, c in histogram.items():
        sums = {s + n * k for s in sums for k in range(c + 1) if s + n * k <= room}
    return max(sums)


def test_license_places(spark, documents, empty, tricky):
    rows = {r["doc_id"]: r for r in license_scan.scan(documents).collect()}
    for doc_id, text, *_ in tricky:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text or ""))
        places = [
            (i, label)
            for phrase, label in license_scan.BASE_PHRASES.items()
            for i in range(len(words))
            if words[i : i + len(phrase.split())] == phrase.split()
        ]
        r = rows[doc_id]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert r["first_word"] == min((i for i, _ in places), default=None)
        assert r["last_word"] == max((i for i, _ in places), default=None)
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
    assert rows[16]["labels"] == "apache,apache-2.0,gpl,gpl-3.0,mit"
    assert rows[7]["labels"] == "" and rows[7]["score"] == 0
    assert license_scan.scan(empty).count() == 0


def test_license_suppression():
    d = license_scan.Detection
    outer, inner, beside = d(0, 6, "a-2.0", 80), d(1, 3, "a", 50), d(5, 8, "b", 50)
    higher = d(6, 7, "c", 90)
    assert license_scan.suppress([inner, outer, beside, higher, outer]) == [outer, beside, higher]
    assert len(license_scan.rules()) > 300


def brute_detections(words):
    """All rules over all places without any gate, then each detection against every other one."""
    line = " " + " ".join(words) + " "
    rules = _CACHE.get("rules") or _CACHE.setdefault(
        "rules", [(r.label, r.priority, re.compile(r.pattern.pattern.decode())) for r in license_scan.rules()]
    )
    found = []
    for label, priority, pattern in rules:
        for m in pattern.finditer(line):
            first = line[: m.start()].count(" ") - 1
            found.append((first, first + len(m[0].split()), label, priority))

    def beats(k, d):
        inside = k[0] <= d[0] and d[1] <= k[1]
        return inside and (k[3] > d[3] or k[3] == d[3] and ((k[0], k[1]) != (d[0], d[1]) or k[2] < d[2]))

    return {d for d in found if not any(beats(k, d) for k in found)}


LICENSE_WORDS = (
    "the gnu lesser affero general public license licence gpl gplv3 lgpl mit apache bsd 2 3 0 1 v v2 version or at your "
    "option any later only spdx identifier licensed under terms of a as published by free software foundation either "
    "creative commons cc by sa nc mozilla 4 clause all rights reserved copyright 2020 domain public in x"
).split()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(LICENSE_WORDS), max_size=40))
def test_license_detections_equal_brute_force(words):
    scanner = _CACHE.get("scanner") or _CACHE.setdefault("scanner", license_scan.Scanner())
    _, found = scanner.scan([w.encode() for w in words])
    got = [(d.first, d.end, d.label, d.priority) for d in found]
    assert len(got) == len(set(got)) and set(got) == brute_detections(words)


def _written(pattern):
    """A text that a pattern without nested groups takes: first choices, nothing optional."""
    before = None
    while before != pattern:
        before = pattern
        pattern = re.sub(r"\(\?:[^()]*\)(\?|\{0,\d+\}\?)", "", pattern)
        pattern = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)(?:\{1,\d+\}\?)?", r"\1", pattern)
    pattern = re.sub(r"\[\^ \]\+", "word", pattern).replace("(?:19|20)[0-9]{2}", "2020")
    pattern = re.sub(r"\[0-9\]\{2\}", "20", pattern)
    return " ".join(re.sub(r".\?", "", re.sub(r"\[(.)[^\]]*\]", r"\1", pattern)).split())


@pytest.mark.parametrize("statement", license_scan.STATEMENTS, ids=lambda s: s[3][:30])
def test_license_statements_are_found(statement):
    label, _, _, pattern = statement
    words = f"x {_written(pattern)} y".split()
    scanner = _CACHE.get("scanner") or _CACHE.setdefault("scanner", license_scan.Scanner())
    _, found = scanner.scan([w.encode() for w in words])
    assert {(d.first, d.end, d.label, d.priority) for d in found} == brute_detections(words)
    assert any(re.fullmatch(pattern, " ".join(words[i:j])) for i in range(2) for j in range(i + 1, len(words)))
    assert any(d.label == label or d.first <= 1 for d in found)


@pytest.mark.parametrize(
    ("text", "label"),
    [
        ("either GNU General Public License as published by the Free Software Foundation, either version 3 of the "
         "License, or (at your option) any later version.", "gpl-3.0-or-later"),
        ("GPL-2.0 or (at your option) any later version", "gpl-2.0-or-later"),
        ("SPDX-License-Identifier: GPL-2.0-only", "gpl-2.0-only"),
        ("SPDX-License-Identifier: LGPL-2.1-or-later", "lgpl-2.1-or-later"),
        ("see https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa-4.0"),
        ("under GPLv3", "gpl-3.0"),
    ],
)
def test_license_versions(text, label):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    _, found = license_scan.Scanner().scan([w.encode() for w in words])
    assert [d.label for d in found] == [label]


@pytest.mark.parametrize("part", ["mit license ", "gpl 2 0 or at your option any later version ", "neither the name of ", "gnu "])
def test_license_scan_of_long_texts_takes_linear_time(part):
    words = (part * (1_000_000 // len(part))).encode().split()
    begin = time.process_time()
    license_scan.Scanner().scan(words)
    assert time.process_time() - begin < 10


def test_quality_counts(spark, documents, empty, tricky):
    rows = {r["doc_id"]: r for r in quality_rules.quality_filter(documents).collect()}
    for doc_id, text, *_ in tricky:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        n = len(words)
        windows = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
        repeated = {k for i in range(n - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        want = [n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)]
        r = rows[doc_id]
        assert [r[c] for c in quality_rules.BASE] == want
        assert r["base_failed"] == (n < 10 or 100 * len(repeated) > 20 * n)
        assert not (r["base_failed"] and r["kept"])
    assert rows[6]["kept"] and rows[7]["kept"]
    assert quality_rules.quality_filter(empty).count() == 0


def test_votes_find_planted_junk(words):
    table, votes = WordHashes(), []
    good = [words(i, 120).replace(" ", ", ", 3).capitalize() + "." for i in range(200)]
    bad = [" ".join(w + "***" for w in words(i, 120).split()) for i in range(20)]
    for text in good + bad:
        base, signals = quality_rules.measure(text.encode(), table)
        votes.append(quality_rules.vote(signals, base[0]))
    values, inverse, counts = np.unique(votes, return_inverse=True, return_counts=True)
    model = quality_rules.fit_votes(quality_rules.digits(values), counts.astype(float))
    quality = model.posterior(quality_rules.digits(values))[inverse]
    assert (quality[:200] > 0.5).all() and (quality[200:] < 0.5).all()


def brute_forward(pieces, word, column):
    known = {p: i for i, (p) in enumerate(pieces[0])}
    text = "▁" + word
    alpha = [1.0] + [0.0] * len(text)
    for j in range(1, len(text) + 1):
        for i in range(j):
            if text[i:j] in known:
                alpha[j] += alpha[i] * pieces[1][known[text[i:j]], column]
            elif j - i == 1:
                alpha[j] += alpha[i] * language_id.UNKNOWN
    return np.log(alpha[-1])


def test_forward_sums_all_segmentations(vocabulary_path):
    names = language_id.vocabulary(vocabulary_path("piece_bpe_32k.model"))
    chances = np.random.default_rng(1).random((len(names), 2)) / len(names)
    model = language_id.PieceModel(names, chances)
    tested = ["the", "straße", "a", "漢字", "internationalisation", "qzxqzx"]
    got = model.forward(tested)
    for k, word in enumerate(tested):
        for column in (0, 1):
            assert got[k, column] == pytest.approx(brute_forward((names, chances), word, column))
    counts = model.expected_counts(["a"], np.array([[2.0, 0.0]]))
    assert counts[:, 1].sum() == 0 and counts[:, 0].sum() <= 4


def test_language_edges(spark, documents, empty, tricky, vocabulary_path):
    names = language_id.vocabulary(vocabulary_path("piece_bpe_32k.model"))
    rows = {r["doc_id"]: r for r in language_id.identify(documents, names).collect()}
    assert len(rows) == len(tricky)
    for doc_id, text, *_ in tricky:
        has_letter = any(c.isalpha() for c in text or "")
        assert (rows[doc_id]["lang_pred"] == "und") == (not has_letter)
        assert rows[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= rows[doc_id]["score"] <= 1
    assert language_id.identify(empty, names).count() == 0
    unlabelled = documents.selectExpr("doc_id", "text", "cast(null as string) lang")
    assert {r["lang_pred"] for r in language_id.identify(unlabelled, names).collect()} == {"und"}


def test_language_accuracy(spark, vocabulary_path):
    names = language_id.vocabulary(vocabulary_path("piece_bpe_32k.model"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = language_id.identify(docs, names).where("held_out").join(docs, "doc_id").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.95 * len(found) > 0


PAGE = (
    "<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body class='home'>"
    "<header><a href=/>Site</a></header><div class='nav-menu'><ul><li>Menu<li>More</ul></div>"
    "<div class=content><p>Intro {0} &amp; more<p>Second   {1}<br>line</p></div>"
    "<div id='comments'><p>first!</div><div class='widget'>Posted</div><p>Read our terms</p><footer>&copy; x</footer></body>"
)


def test_html_templates(spark, words):
    rows = [(i, f"https://a.example/{i}", PAGE.format(words(i, 20), words(i + 50, 30))) for i in range(12)]
    odd = [
        (100, "https://b.example/x", None),
        (101, "https://b.example/y", ""),
        (102, None, "plain &lt;text&gt; a < b"),
        (103, "https://c.example/1", "<article><h1>H</h1><p>x<p>y<aside>no</aside></article><nav>no</nav>"),
        (104, "https://c.example/1", "<article><h1>H</h1><p>x<p>y<aside>no</aside></article><nav>no</nav>"),
        (105, "no url", "<p>" * 3000 + "deep" + "<div class='"),
    ]
    df = spark.createDataFrame(rows + odd, "page_id long, url string, html string")
    out = html_extract.extract(df.withColumn("host", df.url)).collect()
    text = {r["page_id"]: r["text"] for r in out}
    assert len(out) == len(rows) + len(odd)
    for i in range(12):
        assert text[i] == f"Intro {words(i, 20)} & more\n\nSecond {words(i + 50, 30)} line"
    assert (text[100], text[101], text[102]) == ("", "", "plain <text> a < b")
    assert text[103] == text[104] == "H\n\nx\n\ny" and "deep" in text[105]
    assert html_extract.extract(df.limit(0)).count() == 0


TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\s(?:[^>\"']|\"[^\"]*\"|'[^']*')*|/)?)>|<[!?][^>]*>", re.S
)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["<a", "<B ", "</a", "<!--", "-->", "<!", "<?", ">", "/>", "'", '"', " ", "x", "<", "="]), max_size=30))
def test_html_tags_equal_a_plain_pattern(parts):
    page = "".join(parts)
    want = [(m.start(), m.end(), m[1] or "", (m[2] or "").lower(), m[3] or "") for m in TAG.finditer(page)]
    tags, at, got = html_extract._Tags(page), 0, []
    while found := tags.after(at):
        got.append(found)
        at = found[1]
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("article main section div p li td b".split()), st.booleans(), st.integers(0, 9)), max_size=30))
def test_html_article_equals_plain_weighing(parts):
    page = "".join(f"<{'/' * closes}{tag}>" + "y" * n for tag, closes, n in parts)
    _, blocks = html_extract.parse(page)

    def above(node):
        return [] if node is None else [*above(node.parent), node]

    weights = Counter()
    order = {}
    for b in blocks:
        for node in above(b.node):
            weights[id(node)] += len(b.text)
            order.setdefault(id(node), node)
    total = sum(len(b.text) for b in blocks)
    named = [n for n in order.values() if n.tag in ("article", "main")]
    best = max(named, key=lambda n: (weights[id(n)], len(above(n))), default=None)
    if best is None or 2 * weights[id(best)] < total:
        fits = [n for n in order.values() if n.tag in html_extract.CONTAINERS and weights[id(n)] >= 0.8 * total]
        best = max(fits, key=lambda n: len(above(n)), default=None)
    want = [b.text for b in blocks if best is None or any(n is best for n in above(b.node))]
    assert html_extract.main_blocks(blocks, set(), set()) == want


@pytest.mark.parametrize("page", ["<div>x" * 20_000, "<p>" * 100_000 + "x", "<a '" * 250_000, "<a \"'" * 200_000, "<a " * 330_000, "<! " * 330_000])
def test_html_of_hostile_pages_takes_linear_time(page):
    begin = time.process_time()
    _, blocks = html_extract.parse(page)
    assert html_extract.main_blocks(blocks, set(), set())
    assert time.process_time() - begin < 10


def test_html_text_behind_a_line_break_lies_in_its_own_element():
    _, blocks = html_extract.parse("<div><p>a</p></div><section><br>b</section>")
    assert [(b.node.tag, b.text, b.place) for b in blocks] == [("p", "a", 2), ("section", "b", 6)]


def test_html_slots_of_the_host_outweigh_one_page(spark, words):
    # On page 9 another element holds most of the text; no element has the name of an article.
    page = "<body><div class=lead><p>{}</p></div><div class=story><p>{}</p><p>{}</p></div><div class=end><p>{}</p></div>"
    rows = [(i, f"https://a.example/{i}", page.format(words(i, 3), words(i + 20, 60), words(i + 40, 9), words(i + 60, 2))) for i in range(9)]
    rows.append((9, "https://a.example/9", page.format(words(9, 80), words(29, 4), words(49, 3), words(69, 2))))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    text = {r["page_id"]: r["text"] for r in html_extract.extract(df).collect()}
    assert text == {i: f"{words(i + 20, 60)}\n\n{words(i + 40, 9)}" if i < 9 else f"{words(29, 4)}\n\n{words(49, 3)}" for i in range(10)}


def read_templates(spark, pages):
    """The template of each host of (host, html) rows, and where each of its classes occurs on each page."""
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_key long, host string, html string")
    templates = {r["host"]: r.asDict(True) for r in html_extract.host_templates(df.repartition(4)).collect()}
    found = {host: [] for host in templates}
    for host, page in pages:
        stream = html_extract.page_stream(*html_extract.parse(page))[0].tolist()
        places = {}
        for at, cls, place in html_extract.Template(templates[host]["template"]).follow(stream).found:
            places.setdefault(cls, []).append((at, place))
        found[host].append(places)
    return templates, found


def test_html_tokens_are_told_by_their_slot(spark):
    page = "<body><p>{}</p><div class=x><b>{}</b></div><p>{}</p><p>{}</p></body>"
    templates, _ = read_templates(spark, [("h", page.format(*[f"{i} {j}" for j in range(4)])) for i in range(5)])
    tokens = Counter((r["level"], r["class"]) for r in templates["h"]["template"])
    # The paragraphs in front of the div and those behind it are two classes inside the template of the rest.
    assert sorted((level, n) for (level, _), n in tokens.items()) == [(0, 6), (1, 2), (1, 2)]


def test_html_classes_are_in_order_and_nested_on_every_page(spark):
    dice = random.Random(5)

    def part(depth):
        name = dice.choice("abcdef")
        inner = "".join(part(depth + 1) for _ in range(dice.randint(0, 2))) if depth < 3 else ""
        return f"<div class={name}><p>{dice.choice(['x', 'y', dice.random()])}</p>{inner}</div>"

    pages = []
    for host in range(40):
        shared = [part(1) for _ in range(4)]
        for _ in range(6):
            own = [x for x in shared if dice.random() < 0.8] + [part(1) for _ in range(dice.randint(0, 2))]
            if dice.random() < 0.3:
                dice.shuffle(own)
            pages.append((str(host), f"<body><i></i>{''.join(own)}<u></u></body>"))
    templates, found = read_templates(spark, pages)
    assert len(templates) == 40 and sum(len({r["class"] for r in t["template"]}) > 2 for t in templates.values()) > 20
    for host, of_pages in found.items():
        size = Counter(r["class"] for r in templates[host]["template"])
        assert min(size.values(), default=2) >= 2
        for places in of_pages:
            for cls, own in places.items():
                assert [place for _, place in own] == list(range(size[cls])) * (len(own) // size[cls])

        def gaps(a, b, of_pages=of_pages, size=size):
            """The gaps of a in which occurrences of b lie (0: outside); None for one that lies in several."""
            out = set()
            for places in of_pages:
                around, own = ([at for at, _ in places.get(cls, [])] for cls in (a, b))
                for k in range(0, len(own), size[b]):
                    before = {bisect.bisect(around, at) for at in own[k : k + size[b]]}
                    out.add(before.pop() % size[a] if len(before) == 1 else None)
            return out

        for a, b in itertools.combinations(size, 2):
            both = gaps(a, b), gaps(b, a)
            assert both == ({0}, {0}) or any(len(x) == 1 and x.isdisjoint({0, None}) for x in both)


def test_ids_digest_matches_contract(spark, vocabulary_path):
    from tabloom.llm import queries

    library = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    rows = {r["doc_id"]: r for r in queries.op1_sentencepiece(spark, "/root/testdata/sf0.001").collect()}
    for d in docs:
        ids = library.encode(d["text"] or "")
        assert rows[d["doc_id"]]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize(("text", "letters"), [("½ ² ① Ⅷ", False), ("12 _ -", False), ("½a", True), ("漢", True), ("ª", True)])
def test_undetermined_is_a_text_without_letters(text, letters):
    assert bool(language_id.words_of(text)) is letters is any(c.isalpha() for c in text)
