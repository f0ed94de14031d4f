"""Packing and byte-level BPE."""

import base64
import random
import zlib
from array import array
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from flightloom.llm import bpe, packing
from flightloom.llm.queries import RANKS, TOKENIZER, op1_packing, op8_bpe

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(TOKENIZER)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check_packing(rows, texts, library, capacity=1024):
    """Pieces cover each document once, sequences are gapless and within capacity."""
    want = Counter()
    for doc_id, text in texts:
        ids = library(text) + [0]
        want[(doc_id, len(ids), zlib.crc32(array("I", ids).tobytes()))] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert sum(r.length for r in rows) == sum(n * c for (_, n, _), c in want.items())
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return by_doc, len(by_sequence)


def test_packing_of_whole_documents(spark, library):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = op1_packing(spark, SF_DIR).collect()
    by_doc, sequences = check_packing(rows, texts, library)
    for doc_id, text in texts:
        ids = library(text) + [0]
        for r in by_doc[doc_id]:
            assert r.ids_crc32 == zlib.crc32(array("I", ids[r.start : r.start + r.length]).tobytes())
            assert r.doc_tokens == len(ids)
        assert sorted((r.start, r.length) for r in by_doc[doc_id])[0][0] == 0
    assert sequences <= -(-sum(r.length for r in rows) // 1024) + 3


def test_packing_edges(edge_docs, no_docs, library):
    packed = packing.pack(edge_docs, TOKENIZER, public_tokenizers.PATTERN, 64, keep_ids=True).collect()
    check_packing(packed, [(r.doc_id, r.text) for r in edge_docs.collect()], library, 64)
    assert all(zlib.crc32(array("I", r.ids).tobytes()) == r.ids_crc32 and len(r.ids) == r.length for r in packed)
    assert Counter(r.doc_id for r in packed)[3] == Counter(r.doc_id for r in packed)[4] == 1
    assert packing.pack(no_docs, TOKENIZER, public_tokenizers.PATTERN).count() == 0


@pytest.mark.parametrize("seed", range(20))
def test_shortest_pack_first_places_everything(seed):
    rng = random.Random(seed)
    histogram = Counter(rng.choice([rng.randint(1, 100), rng.randint(1, 8), 50]) for _ in range(rng.choice([1, 5, 2000])))
    patterns = packing.shortest_pack_first(histogram, 100)
    placed = Counter()
    for pattern, count in patterns:
        assert sum(pattern) <= 100 and count > 0
        for length in pattern:
            placed[length] += count
    assert placed == histogram


def test_bpe_is_the_library_s(spark, reference):
    rng = random.Random(5)
    letters = "aābc  '\n\t1٣2中🙂sreve.,-" + "  \x1c\x85"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["a" * 50_000, "ab" * 20_000 + " " * 3000, "é" * 10_000, "", " ", "  x", "x ", "don't  stop\n\n now"]
    encode = bpe.text_encoder(bpe.Vocabulary(RANKS), public_tokenizers.PATTERN)
    packed = packing.document_ids(TOKENIZER, public_tokenizers.PATTERN)
    for text in texts:
        want = array("I", reference.encode_ordinary(text)).tobytes()
        assert encode(text) == want
        assert packed(text) == want


def test_bpe_query_round_trip(spark, edge_docs, no_docs, reference):
    rows = {r.doc_id: r for r in op8_bpe(spark, SF_DIR).collect()}
    for doc in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect():
        ids = reference.encode_ordinary(doc.text or "")
        got = rows[doc.doc_id]
        assert (got.n_tokens, got.ids_sha256) == (len(ids), bpe.sha256_hex(array("I", ids).tobytes()))
        assert got.decoded_sha256 == bpe.sha256_hex((doc.text or "").encode())
    decoded = bpe.decode(bpe.encode(edge_docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()
    want = Counter((r.doc_id, (r.text or "").encode()) for r in edge_docs.collect())
    assert Counter((r.doc_id, bytes(r.decoded)) for r in decoded) == want
    assert bpe.encode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


def test_batches_are_smaller_where_ids_are_kept(spark):
    docs = spark.range(1200).selectExpr("id AS doc_id", "concat('text ', id) AS text").coalesce(1)
    args = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    cut = packing.pieces(docs, *args, keep_ids=True)
    sizes = cut.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long").collect()
    assert sum(r.n for r in sizes) == 1200 and max(r.n for r in sizes) <= 500
