"""Cross-tokenizer alignment against a plain merge of byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from tabloom.llm import alignment, queries

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(BYTE_LEVEL)
    coder.encode_special_tokens = True
    return coder, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def brute(text, libraries):
    """Tokens, links and byte ends of groups of one text, by the definition."""
    coder, processor = libraries
    if not text:
        return [], [], [], []
    signs = alignment._byte_of_sign()
    a = coder.encode(" " + text, add_special_tokens=False).ids
    b = processor.encode(text)
    a_bytes = [bytes(signs[c] for c in coder.id_to_token(i)) for i in a]
    b_bytes = [alignment.piece_bytes(processor.id_to_piece(i)) for i in b]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], [], [], []

    def ranges(parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return list(zip([0, *ends[:-1]], ends, strict=True))

    a_range, b_range = ranges(a_bytes), ranges(b_bytes)
    links, first = [], 0
    for i, (x, y) in enumerate(a_range):
        while b_range[first][1] <= x:
            first += 1
        j = first
        while j < len(b_range) and b_range[j][0] < y:
            links.append((i, j))
            j += 1
    return a, b, links, sorted({y for _, y in a_range} & {y for _, y in b_range})


def group_digest(a, b, a_ends, b_ends, cuts):
    groups, i, j = [], 0, 0
    for cut in cuts:
        x, y = i, j
        while i < len(a) and a_ends[i] <= cut:
            i += 1
        while j < len(b) and b_ends[j] <= cut:
            j += 1
        groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
    return hashlib.sha256(";".join(groups).encode()).hexdigest()


def expected(rows, libraries):
    """The contract's rows from plain Python."""
    signs = alignment._byte_of_sign()
    coder, processor = libraries
    found = [brute(t, libraries) for _, t in rows]
    holders = Counter()
    for a, b, links, _ in found:
        holders.update({(a[i], b[j]) for i, j in links})
    highest = defaultdict(int)
    for (x, _), n in holders.items():
        highest[x] = max(highest[x], n)
    out = []
    for (doc_id, _), (a, b, links, cuts) in zip(rows, found, strict=True):
        pairs = [(a[i], b[j]) for i, j in links]
        digest = ""
        if a:
            a_ends = np.cumsum([len([signs[c] for c in coder.id_to_token(i)]) for i in a]).tolist()
            b_ends = np.cumsum([len(alignment.piece_bytes(processor.id_to_piece(i))) for i in b]).tolist()
            digest = group_digest(a, b, a_ends, b_ends, cuts)
        best = sum(holders[p] == highest[p[0]] for p in pairs)
        out.append((doc_id, len(a), len(b), len(cuts), len(links), best, sum(holders[p] for p in pairs), digest))
    return out


def odd_texts(tricky):
    blanks = [" ", "  ", " a", "a ", "a  b", "a\n b", "a \n  b", "\n", "\t\t x", "a b", "a b", "x y", "\x1c a", "don't 's '"]
    mixed = random.Random(3)
    signs = "ab '.\n\té漢\U0001f600 1,s\x00\x85"
    blanks += ["".join(mixed.choices(signs, k=mixed.randint(1, 60))) for _ in range(150)]
    return [(i, t) for i, t, *_ in tricky] + [(1000 + i, t) for i, t in enumerate(blanks)] + [(None, "one two"), (4, "One")]


def test_statistics(spark, tricky, libraries):
    rows = odd_texts(tricky)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, block string").repartition(3)
    names = [x.split()[0] for x in alignment._DOCUMENTS.split(", ")]
    got = [tuple(r[n] for n in names) for r in alignment.link_statistics(df, BYTE_LEVEL, PIECES).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected(rows, libraries)))


def test_links_and_cuts(spark, tricky, libraries):
    rows = odd_texts(tricky)
    df = spark.createDataFrame([(i, t, "old") for i, t in rows], "doc_id long, text string, links string").repartition(2)
    for row in alignment.align(df, BYTE_LEVEL, PIECES).collect():
        a, b, links, cuts = brute(row["text"], libraries)
        assert (row["a_ids"], row["b_ids"]) == (a, b)
        assert [tuple(x) for x in row["links"]] == links
        assert row["cuts"] == cuts


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.link_statistics(df, BYTE_LEVEL, PIECES).count() == 0
    assert alignment.align(df, BYTE_LEVEL, PIECES).count() == 0


@pytest.mark.parametrize("lane", [1, 3, 1000])
def test_lanes_change_nothing(lane):
    """Random token lengths, some documents without a common end but their last."""
    draw = random.Random(lane)
    lengths = np.arange(6)
    a, b, a_at, b_at = [], [], [0], [0]
    for size in [0, 1, 5, 700, 40, 0, 3000]:
        for out, at in ((a, a_at), (b, b_at)):
            left = size
            while left:
                out.append(min(left, draw.randint(1, 5)))
                left -= out[-1]
            at.append(len(out))
    # 2 + 4 * n against 4 * n + 2: the ends meet only at the end.
    a += [2, *[4] * 500]
    b += [*[4] * 500, 2]
    a_at.append(len(a))
    b_at.append(len(b))
    found = alignment.lockstep(*map(np.array, (a, a_at, b, b_at)), lengths, lengths, lane)
    a_end, b_end = np.cumsum(a), np.cumsum(b)
    want = {(i, j) for i in range(len(a)) for j in range(len(b)) if a_end[i] - a[i] < b_end[j] and b_end[j] - b[j] < a_end[i]}
    got = list(zip(found.link_a.tolist(), found.link_b.tolist(), strict=True))
    assert len(got) == len(want) and set(got) == want
    assert set(a_end[found.cut_a]) == set(a_end) & set(b_end) and len(found.cut_a) == len(set(a_end) & set(b_end))
    assert (a_end[found.cut_a] == b_end[found.cut_b]).all()


def test_long_text(libraries):
    """A million characters without a space, and long runs of blanks, take seconds."""
    tokenizers = alignment.Tokenizers(BYTE_LEVEL, PIECES)
    found = alignment._align(tokenizers, ["x" * 300_000, " " * 200_000 + "a", "ab " * 200_000])
    assert found.per_document(found.cut_a).min() > 0


def test_query(spark, libraries):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    names = [x.split()[0] for x in alignment._DOCUMENTS.split(", ")]
    got = [tuple(r[n] for n in names) for r in queries.op13_alignment(spark, sf_dir).collect()]
    assert sorted(got) == sorted(expected(rows, libraries))
