import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import packing, simple8b, token_ids
from tests.llm.samples import documents, frame


def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def plain_ids(rows, end):
    tok = library()
    return [(i, tok.encode(t or "", add_special_tokens=False).ids + [end]) for i, t, *_ in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("length", [16, 1024])
def test_pieces_cover_every_id_once(spark, length):
    rows = documents()
    got = packing.pack(frame(spark, rows), length, with_ids=True).collect()
    by_sequence = {}
    for p in got:
        by_sequence.setdefault(p.sequence_id, []).append(p)
        assert p.length > 0 and crc(np.frombuffer(bytes(p.ids), "<u4")) == p.ids_crc32
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for k, pieces in by_sequence.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length or (k == max(by_sequence) and 0 < at < length)
    # Whole documents come back from their pieces, repeated rows as often as they stand there.
    whole = {}
    for p in sorted(got, key=lambda p: (p.sequence_id, p.offset)):
        open_ = whole.setdefault(p.doc_id, [[]])
        if p.start == 0 and open_[-1]:
            open_.append([])
        assert len(open_[-1]) == p.start
        open_[-1].extend(np.frombuffer(bytes(p.ids), "<u4").tolist())
        assert p.doc_tokens >= len(open_[-1])
    want = {}
    for i, ids in plain_ids(rows, 0):
        want.setdefault(i, []).append(ids)
    assert {k: sorted(v) for k, v in whole.items()} == {k: sorted(v) for k, v in want.items()}


def test_pack_of_nothing(spark):
    assert packing.pack(frame(spark, documents()).where("false")).collect() == []


def test_chunked_ids_are_the_library_s():
    tok = library()
    rng = random.Random(3)
    alphabet = "ab É'!.,\n  \tñ1²½日_-# ́sted"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += ["<|endoftext|>", "a <|endoftext|> b", "one\n<|endoftext|>two", "<|endoftext", "x<|endoftext|><|endoftext|> y z"]
    assert tok.encode("<|endoftext|>", add_special_tokens=False).ids == [50256]
    as_text = token_ids.ChunkEncoder(token_ids.default_tokenizer(), special_as_text=True).encode(["<|endoftext|>"])
    assert len(as_text[0]) > 4 and any("<|endoftext|>" in r[1] for r in documents() if r[1])
    got = token_ids.ChunkEncoder(token_ids.default_tokenizer()).encode(texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [tok.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("block", [64, 1024])
def test_simple8b_round_trip(block):
    rng = np.random.default_rng(0)
    for values in (rng.integers(0, 50257, 5000), np.zeros(3000), rng.integers(0, 1 << 62, 700), np.array([2**64 - 1, 0, 2**60, 2**60 - 1, 15 << 60, 1], np.uint64), np.array([])):
        values = np.asarray(values).astype(np.uint64)
        words, first = simple8b.encode_blocks(values, block)
        assert (simple8b.decode_blocks(words, first, len(values), block) == values).all()
    assert len(simple8b.encode_blocks(np.zeros(600), 1024)[0]) == 10


def test_damaged_shard_is_noticed():
    payload = bytearray(simple8b.dump_shard([1, None], np.array([2, 1]), np.array([7, 8, 9])))
    ids, lengths, values = simple8b.load_shard(bytes(payload))
    assert ids == [1, None] and lengths.tolist() == [2, 1] and values.tolist() == [7, 8, 9]
    assert payload.startswith(b"TS8B 2 2 3 1024 1 ") and payload[-1:] == b"\n"
    payload[140] ^= 1
    with pytest.raises(ValueError):
        simple8b.load_shard(bytes(payload))


def test_ids_by_files(spark, tmp_path):
    rows = documents()
    path = str(tmp_path / "ids")
    simple8b.write_ids(frame(spark, rows), path)
    files = [p for p in (tmp_path / "ids").iterdir() if p.name.startswith("part-")]
    assert sum(len(simple8b.load_shard(p.read_bytes())[0]) for p in files if p.stat().st_size) == len(rows)
    got = sorted(simple8b.read_ids(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda i: (i is not None, i))
    at, want = 0, {}
    for i, ids in plain_ids(rows, 2):
        want.setdefault(i, []).append(ids)
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and crc(r.ids) == r.ids_crc32
        want[r.doc_id].remove(list(r.ids))
        at += r.n_tokens
    assert not any(want.values())
    simple8b.write_ids(frame(spark, rows).where("false"), str(tmp_path / "none"))
    assert simple8b.read_ids(spark, str(tmp_path / "none")).collect() == []
