import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from lumiflux.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "a <|endoftext|> b", "  two  spaces\n new\x85 x y é  a", "it's I'll \x1c a b", "­ a", "ab cd퟿ e 12 a3 b", "don't the's we'll. go (a) b-c --d\n(e) f\n", "a b\n c", "x\n\ny z ", "測試 text ſ z", "a\nB c.\nD, e\nf"]


def signed(text):
    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def plain(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_encode_as_whole_texts_do(spark, sf, name):
    path = public_tokenizers.path(name)
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    t = Tokenizer.from_file(path)
    enc = tokens.Encoder(path)
    for _ in range(2):
        got = enc.encode(texts)
        enc.pieces.age()
        for x, g in zip(texts, got):
            assert np.frombuffer(g, enc.dtype).tolist() == t.encode(x, add_special_tokens=False).ids


def test_round_trip(spark, docs, rows, empty):
    got = tokens.report(docs, PATH).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, signed(r[1] or ""), r[1] or ""))
    start, want = 0, []
    for r in order:
        ids = [*plain(r[1]), 2]
        want.append((str(r[0]), start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted((str(r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    assert tokens.report(empty, PATH).count() == 0


def test_files_give_sequences_and_masks(spark, docs):
    shards = tokens.write(docs, PATH, length=64).collect()
    for s in shards:
        f = tokens.TokenFile(f"{s.path}.arrow")
        n = -(-s.n_tokens // 64)
        masks = np.concatenate([f[i][1] for i in range(n)])
        assert masks.sum() == s.n_tokens and masks[: s.n_tokens].all()
        whole = np.concatenate(list(f.tokens(0, s.n_tokens)))
        assert (np.concatenate([f[i][0] for i in range(n)])[: s.n_tokens] == whole).all() and whole[-1] == 2


def test_ids_and_masks_are_views_of_the_map(spark, docs):
    s = tokens.write(docs, PATH, length=64).first()
    f = tokens.TokenFile(f"{s.path}.arrow")
    for x in f[0]:
        assert not x.flags.owndata and not x.flags.writeable
    ids, mask = (f.reader.get_batch(0).column(i).flatten() for i in (0, 1))
    assert f[0][1].ctypes.data == mask.buffers()[1].address and f[0][0].ctypes.data == ids.buffers()[1].address


def test_files_of_lost_attempts_go(spark, docs, tmp_path):
    folder = f"file://{tmp_path}/t"
    (tmp_path / "t").mkdir()
    for name in ("part-000000-999999.arrow", "part-000000-999999.docs.arrow"):
        (tmp_path / "t" / name).write_bytes(b"torn")
    shards = tokens.write(docs, PATH, folder=folder)
    names = {s.path.rsplit("/", 1)[-1] for s in shards.collect()}
    assert {f.name.split(".")[0] for f in (tmp_path / "t").iterdir() if not f.name.startswith(".")} == names
    assert tokens.read(shards).count() == docs.count()


@pytest.mark.parametrize("n", [1, 255, 256, 257, 511, 512, 513, 40_000])
def test_equal_masks_are_kept_once(spark, n):
    """Shards of n tokens, 256 a batch: every sequence has its mask, and whole batches add none to the files."""
    text = " a" * (n - 1)
    assert len(plain(text)) == n - 1
    (s,) = tokens.write(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH, length=256 // tokens.BATCH).collect()
    f = tokens.TokenFile(f"{s.path}.arrow")
    rows = -(-n // f.length)
    ids, mask = (np.concatenate([f[i][k] for i in range(rows)]) for k in (0, 1))
    assert s.n_tokens == n and ids[:n].tolist() == [*plain(text), 2] and not ids[n:].any() and mask[:n].all() and not mask[n:].any()
    batches = [f.reader.get_batch(k) for k in range(f.reader.num_record_batches)]
    assert sum(b.num_rows for b in batches) == rows and all(b.num_rows == tokens.BATCH for b in batches[:-1])
    held = {b.column(1).flatten().buffers()[1].address for b in batches}
    assert len(held) <= 2 and not any(x.flags.owndata for i in (0, rows - 1) for x in f[i])
