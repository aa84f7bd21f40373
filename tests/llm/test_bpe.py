import hashlib
import random
import struct

import pytest
from tokenizers import Tokenizer

from silverline.llm import bpe
from tests.llm.fixtures import documents, edge_rows


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.default_vocabulary())


def texts():
    rng = random.Random(5)
    odd = [chr(c) for c in (0, 9, 10, 13, 28, 31, 32, 32, 32, 39, 0x85, 0xA0, 0xB2, 0xE9, 0x301, 0x661, 0x2003, 0x2028,
                            0x2167, 0x200B, 0x3000, 0x4E2D, 0xFEFF, 0xFFFD, 0x1F600)] + list("stl1|<ab")
    out = ["".join(rng.choices(odd, k=rng.randint(0, 30))) for _ in range(3000)]
    out += ["a" * 3000, "<|endoftext|>x<|endoftext|> <|endoftext|>", "  <|endoftext|>  ", "<|endoftext|", " ", "", "a  b"]
    return out + [r[1] or "" for r in edge_rows()]


def test_equals_the_library(library):
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.default_vocabulary()), cache_words=500)
    all_texts = texts()
    mine = [b for run in bpe.batches(all_texts, 2000) for b in encoder.encode(run)]
    theirs = library.encode_batch(all_texts, add_special_tokens=False)
    for text, ids, ref in zip(all_texts, mine, theirs, strict=True):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == ref.ids, text
        assert encoder.decode(ids) == library.decode(ref.ids, skip_special_tokens=False)


def test_malformed_bytes_decode_as_the_library_does(library):
    v = bpe.Vocabulary(bpe.default_vocabulary())
    encoder = bpe.Encoder(v)
    for cut in (b"\xf0\x9f", b"\xff\xfe", b"a\xe2\x82b"):
        ids = [v.byte_ids[b] for b in cut]
        assert encoder.decode(struct.pack(f"<{len(ids)}I", *ids)) == library.decode(ids, skip_special_tokens=False)


def test_query_rows(spark, library):
    rows = edge_rows()
    got = bpe.digests(documents(spark, rows), bpe.default_vocabulary(), ["doc_id"]).collect()
    want = []
    for doc_id, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        packed = struct.pack(f"<{len(ids)}I", *ids)
        want.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    whole = bpe.encode(documents(spark, rows), bpe.default_vocabulary(), ["doc_id"]).collect()
    assert all(len(r["ids"]) in {w[1] for w in want if w[0] == r["doc_id"]} for r in whole)
    assert bpe.digests(documents(spark, []), bpe.default_vocabulary(), ["doc_id"]).count() == 0


def test_runs_of_ascii_letters_are_words_without_the_pattern(library):
    encoder = bpe.Encoder(bpe.Vocabulary(bpe.default_vocabulary()))
    split, seen = encoder.words, []
    encoder.words = lambda run: (seen.append(run), split(run))[1]
    text = "One two two, thr\u00e9e four\nfive 6x it's"
    for again in range(2):
        (ids,) = encoder.encode([text])
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == library.encode(text, add_special_tokens=False).ids
    assert not {"One", " two"} & set(seen) and len(seen) == len(set(seen))
    assert {"One", " two", " two,", ","} <= set(encoder.cache)
