"""Packing, prefix counts and binary ids against the library itself."""

import math
import zlib

import numpy as np
import pytest
from llm_rows import documents, texts

from seekframe.llm import binary, packing, prefixes
from seekframe.llm.common import prepared
from seekframe.llm.tokens import encode, tokenizer, tokenizer_path
from seekframe.session import shared_dir


@pytest.fixture(scope="module")
def path():
    return tokenizer_path("word_bpe_49k.json")


def ids_of(text, path):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


ODD = [
    "x!!<|ENDOFTEXT|>y, z<|startoftext|>. <|endoftext|>",
    "J̌ J̌, İx ΣΣ á \x0bf\x1f \x1c \x85 a b",
    "don't we'LL 're ''s 123 4.5,..., x.,y, z.\n  q",
    "日本語テキスト 한국어 각",
    "Ångström ẹ́x ​ ½²ª ǅ DŽ ß ẞ",
    "",
    " \n x",
]


def test_encode_equals_library(path):
    for text in [*ODD, *(t or "" for _, t in texts())]:
        assert encode(text.encode(), path).tolist() == ids_of(text, path)


def test_every_prefix_equals_library(path):
    for text in ODD:
        counts = np.cumsum(np.frombuffer(prefixes.changes(text, path), np.int8), dtype=int).tolist()
        assert counts == [len(ids_of(text[:i], path)) for i in range(1, len(text) + 1)]


def test_run_of_control_strings(path):
    """Thousands of control strings without a blank: any prefix counts as the library counts it."""
    text = "a" + "<|endoftext|>" * 3000 + "b<|end" + "<|startoftext|>" * 2 + "<|endoftext|>z"
    counts = np.cumsum(np.frombuffer(prefixes.changes(text, path), np.int8), dtype=int).tolist()
    assert len(counts) == len(text)
    for i in [*range(1, 40), 13_001, 26_007, *range(len(text) - 60, len(text) + 1)]:
        assert counts[i - 1] == len(ids_of(text[:i], path))


def test_prefix_tables(spark, path):
    prepared(spark)
    stored = prefixes.count_at(prefixes.kept_letters(prefixes.prefix_tables(documents(spark)), 9), "n_letters")
    known = dict(texts())
    for r in stored.collect():
        text = known[r["doc_id"]] or ""
        assert (r["n_bytes"], r["n_tokens"], r["tokens_at"]) == (len(text.encode()), len(ids_of(text, path)), r["n_tokens"])
        assert len(ids_of(text[: r["keep"]], path)) <= 9
        if len(text) < 1000:
            assert all(len(ids_of(text[:i], path)) > 9 for i in range(r["keep"] + 1, len(text) + 1))
    assert prefixes.prefix_tables(documents(spark, [])).count() == 0


def test_pack_documents(spark, path):
    prepared(spark)
    rows = packing.pack_documents(documents(spark), capacity=64, ids=True).collect()
    known = dict(texts())
    by_sequence, by_doc = {}, {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    for doc, own in by_doc.items():
        whole = [*ids_of(known[doc], path), 0]
        copies = 2 if doc in (5, 6) else 1
        assert sum(r["length"] for r in own) == copies * len(whole)
        for r in own:
            part = whole[r["start"] : r["start"] + r["length"]]
            assert r["start"] == 64 * r["piece"] and np.frombuffer(r["ids"], "<u4").tolist() == part
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= math.ceil(total / 64 * 1.03) + 1
    assert packing.pack_documents(documents(spark, [])).count() == 0


def test_sequences(spark):
    prepared(spark)
    packed = packing.pack_documents(documents(spark), capacity=128, ids=True)
    for r in packing.sequences(packed).collect():
        assert len(r["ids"]) == 4 * r["length"] <= 512


@pytest.mark.parametrize("seed", range(4))
def test_plan_is_near_the_bound(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(2048, rng.lognormal(5.5 + seed / 2, 1.2, 4000).astype(int) + 1)
    histogram = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True))}
    made = packing.plan(histogram)
    assert int((made[:, 2] - made[:, 1]).sum()) == len(lengths)
    bound = max(math.ceil(lengths.sum() / 2048), int((lengths > 1024).sum()))
    assert made[:, 3].max() + 1 <= bound * 1.06 + 2
    for length, n in histogram.items():
        own = made[made[:, 0] == length]
        assert own[0, 1] == 0 and own[-1, 2] == n and (own[1:, 1] == own[:-1, 2]).all()


def test_nnls_meets_its_conditions():
    rng = np.random.default_rng(1)
    a, b = rng.random((12, 30)), rng.random(12)
    x = packing.nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and slope.max() < 1e-6 and abs(slope[x > 0]).max() < 1e-6


def test_binary_files(spark, path):
    prepared(spark)
    docs = documents(spark).where("doc_id is not null")
    folder = shared_dir(spark)
    index = binary.write_ids(docs, folder)
    found = binary.read_ids(index, folder).collect()
    rows = sorted((k, t) for k, t in ((k, t or "") for k, t in texts()) if k is not None)
    at = 0
    want = []
    for key, text in rows:
        ids = [*ids_of(text, path), 1]
        want.append((key, at, len(ids), tuple(ids)))
        at += len(ids)
    got = sorted((r["doc_id"], r["start"], r["n_tokens"], tuple(np.frombuffer(r["ids"], "<u2").tolist())) for r in found)
    assert got == want
    one = binary.read_ids(index.where("doc_id = 204"), folder).collect()
    assert len(one) == 1 and one[0]["n_tokens"] == len(ids_of(dict(texts())[204], path)) + 1
    assert binary.summed(binary.read_ids(binary.write_ids(documents(spark, []), shared_dir(spark)), folder)).count() == 0


def test_frames_are_checked(tmp_path):
    import pyarrow.fs

    store = pyarrow.fs.LocalFileSystem()
    name, data = str(tmp_path / "x.bin"), np.arange(400_000, dtype="<u2").tobytes()
    with store.open_output_stream(name) as out:
        writer = binary.FrameWriter(out)
        writer.write(data)
        writer.close()
    reader = binary.FrameReader(store.open_input_file(name))
    assert len(writer.entries) > 2 and reader.read(5, 700_000) == data[5:700_005] and reader.read(0, 0) == b""
    raw = bytearray((tmp_path / "x.bin").read_bytes())
    raw[60] ^= 1
    (tmp_path / "x.bin").write_bytes(raw)
    with pytest.raises(Exception):  # noqa: B017, PT011
        binary.FrameReader(store.open_input_file(name)).read(0, 10)
