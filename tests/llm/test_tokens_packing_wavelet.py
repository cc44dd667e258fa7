import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kindred.llm import packing, queries, storage, tokens, wavelet

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x250, exclude_categories=["Cs"]), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_pieces_give_the_ids_of_the_whole_text(text):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(PATH)
    assert np.frombuffer(tokens.tokenizer(PATH).encode(text), "<u4").tolist() == ids_of(plain, text)


def test_other_pre_tokenizers_go_whole(tmp_path):
    import json

    from tokenizers import Tokenizer

    spec = json.loads(Tokenizer.from_file(PATH).to_str())
    assert tokens.PieceTokenizer(PATH).by_pieces
    spec["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "Digits", "individual_digits": True}, spec["pre_tokenizer"]]}
    path = str(tmp_path / "other.json")
    with open(path, "w") as f:
        json.dump(spec, f)
    other = tokens.PieceTokenizer(path)
    assert not other.by_pieces
    assert np.frombuffer(other.encode("in 1234 ways"), "<u4").tolist() == Tokenizer.from_file(path).encode("in 1234 ways", add_special_tokens=False).ids


def test_a_small_cache_changes_nothing(plain):
    text = " ".join(f"w{i} it's  {i}\n" for i in range(300))
    small = tokens.PieceTokenizer(PATH, cache=7)
    assert np.frombuffer(small.encode(text), "<u4").tolist() == ids_of(plain, text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70_000), max_size=1500), st.sampled_from([64, 1 << 16]))
def test_wavelet_matrix_against_lists(values, chunk):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(wavelet, "CHUNK", chunk)
        m = wavelet.WaveletMatrix.build(np.array(values, np.uint32))
        assert m.decode().tolist() == values
        for i in range(0, len(values), max(1, len(values) // 7)):
            v = values[i]
            assert m.access(i) == v
            assert m.count(v, 0, i) == values[:i].count(v)
            places = [j for j, x in enumerate(values) if x == v]
            assert [m.select(v, k) for k in range(len(places))] == places
        assert m.count(99_999_999) == 0
        with pytest.raises(IndexError):
            m.select(99_999_999, 0)


def shard_file(uri, docs):
    w = wavelet.ShardWriter()
    for d, ids in docs:
        w.add(d, np.array(ids, "<u4").tobytes())
    with storage.open_write(uri) as out:
        w.write(out)


@pytest.mark.parametrize("chunk", [64, 1 << 16])
def test_shard_file(tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(wavelet, "CHUNK", chunk)
    docs = [(None, [5] * 10), (3, list(range(200))), (3, []), (9, [7, 5, 7])]
    uri = f"file://{tmp_path}/x.kwm"
    shard_file(uri, docs)
    with storage.open_seekable(uri) as file:
        shard = wavelet.Shard(file)
        read = [(d, at, np.frombuffer(raw, "<u4").tolist()) for d, at, raw in shard.documents()]
        assert [(d, ids) for d, _, ids in read] == docs
        assert [at for _, at, _ in read] == [0, 10, 210, 210]
        flat = [x for _, ids in docs for x in ids]
        assert list(shard.occurrences(5)) == [i for i, x in enumerate(flat) if x == 5]
        assert shard.count(7) == flat.count(7) and shard.count(7, 0, 100) == flat[:100].count(7)
        assert [shard.access(i) for i in range(len(flat))] == flat
        with pytest.raises(IndexError):
            shard.access(len(flat))
    shard_file(uri, [])
    assert list(wavelet.Shard(storage.read_bytes(uri)).documents()) == []


def test_lookups_read_a_small_part_of_a_file(tmp_path):
    ids = np.random.default_rng(1).integers(0, 50_000, 500_000)
    shard_file(f"file://{tmp_path}/x.kwm", [(1, ids)])
    data = storage.read_bytes(f"file://{tmp_path}/x.kwm")
    assert len(data) < 0.56 * 4 * len(ids)
    shard = wavelet.Shard(data)
    read, plain = [], shard.read
    shard.read = lambda at, size: read.append(size) or plain(at, size)
    assert shard.access(123_456) == ids[123_456] and sum(read) <= 16 * wavelet.CHUNK // 8 < len(data) / 7
    read.clear()
    assert shard.count(int(ids[9])) == (ids == ids[9]).sum() and sum(read) <= 32 * wavelet.CHUNK // 8


def test_shards_are_closed_by_size(spark, plain, tmp_path, monkeypatch):
    monkeypatch.setattr(wavelet, "SHARD_IDS", 40)
    rows = [(i, "one two three four five six seven eight nine ten") for i in range(30)] + [(31, None)]
    manifest = wavelet.write_shards(spark.createDataFrame(rows, "doc_id long, text string"), f"file://{tmp_path}", PATH, tasks=2)
    files = manifest.orderBy("shard").collect()
    assert len(files) > 4 and all(f["n_ids"] <= 40 + 12 for f in files) and sum(f["n_docs"] for f in files) == 31
    out = sorted(wavelet.read_shards(manifest).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in out] == [*range(30), 31] and out[-1]["start"] == sum(r["n_tokens"] for r in out[:-1])


def test_shards_round_trip(spark, awkward, plain, tmp_path):
    manifest = wavelet.write_shards(awkward, f"file://{tmp_path}", PATH, tasks=3)
    rows = wavelet.read_shards(manifest).collect()
    expected = sorted((r["doc_id"] is not None, r["doc_id"] or 0, ids_of(plain, r["text"]) + [2]) for r in awkward.collect())
    found = sorted((r["doc_id"] is not None, r["doc_id"] or 0, np.frombuffer(r["ids"], "<u4").tolist()) for r in rows)
    assert found == expected
    rows.sort(key=lambda r: r["start"])
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(len(rows))]
    ids = [r["doc_id"] for r in rows]
    assert ids == sorted(ids, key=lambda x: (x is not None, x))


def test_no_documents(spark, empty, tmp_path):
    assert wavelet.read_shards(wavelet.write_shards(empty, f"file://{tmp_path}", PATH)).count() == 0
    assert packing.pack(empty, PATH).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=80))
def test_best_fit_against_a_plain_version(lengths):
    seq, off, n = packing.best_fit_decreasing(np.array(lengths, np.int64), 32)
    rooms: list[int] = []
    expected = {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in rooms if r >= lengths[i]]
        expected[i] = min(fits) if fits else 32
        if fits:
            rooms.remove(min(fits))
        rooms.append(expected[i] - lengths[i])
    assert n == len(rooms)
    assert [32 - o for o in off.tolist()] == [expected[i] for i in range(len(lengths))]
    for s in set(seq.tolist()):
        spans = sorted((o, o + x) for o, x, q in zip(off.tolist(), lengths, seq.tolist(), strict=True) if q == s)
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:], strict=False)) and spans[-1][1] <= 32


def test_pack_keeps_every_id_once(spark, awkward, plain, monkeypatch):
    rows = packing.pack(awkward, PATH).collect()
    found = {}
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["length"] * 4 == len(r["ids"]) and 0 < r["length"] <= 2048 and r["offset"] + r["length"] <= 2048
        found.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r["ids"])
    for r in awkward.collect():
        want = np.array(ids_of(plain, r["text"]) + [1], "<u4").tobytes()
        got = b"".join(found[r["doc_id"], len(want) // 4])
        assert got.count(want) >= 1 or sorted(got) == sorted(want * 2)
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_seq.values():
        at = 0
        for o, n in sorted(spans):
            assert o == at
            at += n
    assert sorted(by_seq) == list(range(len(by_seq)))


@pytest.mark.parametrize("repeated", [False, True])
def test_shards_have_sequences_of_their_own(spark, repeated):
    rows = [(None if repeated else i, 0, 1 + i % 700, 1 + i % 700) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, start long, length long, doc_tokens long")
    packed = packing.assign(df, shard_rows=60)
    out = packed.collect()
    used = {}
    for r in out:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert len(out) == 500 and sorted(used) == list(range(len(used)))
    assert all(sum(n for _, n in s) <= 2048 for s in used.values())
    assert sum(n for s in used.values() for _, n in s) / (2048 * len(used)) > 0.8


def test_query_checksums(spark, plain):
    rows = {r["doc_id"]: r for r in queries.op10_token_ids(spark, "/root/testdata/sf0.001").collect()}
    at = 0
    for r in sorted(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect(), key=lambda r: r["doc_id"]):
        raw = np.array(ids_of(plain, r["text"]) + [2], "<u4").tobytes()
        assert (rows[r["doc_id"]]["start"], rows[r["doc_id"]]["ids_crc32"]) == (at, zlib.crc32(raw))
        at += len(raw) // 4
