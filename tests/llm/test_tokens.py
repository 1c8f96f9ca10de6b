import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as pt
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from mediaweave.llm import _bpe, packing, pieces, token_counts
from mediaweave.llm._common import Scratch
from tests.llm import brute

MODEL, VOCABULARY, RANKS = pt.path("piece_bpe_32k.model"), pt.path("byte_bpe_50k.json"), pt.path("byte_bpe_50k.tiktoken")
HARD = ["", "a", " ", "  ", "a  b", "\n\nx y \n z", "trail  ", "\t tab", "日本語 テスト🎉", "x" * 300 + " " + "abcabc" * 40, "a\x00b", "</s> <s> <unk>", "é ñ ü ß\r\n", "...... ---- ====", "    indented\n        more", "a　b c", "don't we'll", "<|endoftext|> hi", "\x1cy z"]


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def noise(n):
    r = random.Random(n)
    return ["".join(r.choice("abeé \n.,'1Z") for _ in range(r.randrange(120))) for _ in range(n)]


def test_pieces_equal_the_library():
    model, library = pieces.pieces(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for texts in (HARD, noise(300)):
        got = [ids(x) for x in model.encode_batch(texts)]
        assert got == library.encode(texts)
        assert [model.decode(np.array(x, int)) for x in got] == texts


def test_pieces_of_tables(spark, data, odd, empty):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    enc = pieces.encode(docs, MODEL)
    by = {r.doc_id: ids(r.ids) for r in enc.collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    assert by == {i: library.encode(t) for i, t in text.items()}
    assert {r.doc_id: r.text for r in pieces.decode(enc, MODEL).collect()} == text
    assert all(r.round_trip for r in pieces.encode_and_check(odd, MODEL).collect()) and pieces.encode(empty, MODEL).count() == 0


def test_small_blocks_and_memory(monkeypatch):
    monkeypatch.setattr(pieces, "INDEXED", 50)
    monkeypatch.setattr(pieces, "REMEMBERED", 10)
    model, library = pieces.Pieces(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for _ in range(2):
        assert [ids(x) for x in model.encode_batch(HARD)] == library.encode(HARD)
    assert len(model.known) < 300


def test_bytes_equal_the_library():
    enc, library = _bpe.encoder(VOCABULARY, RANKS), Tokenizer.from_file(VOCABULARY)
    for t in [*HARD, *noise(300)]:
        assert ids(enc.encode(t)) == library.encode(t, add_special_tokens=False).ids


LENGTHS = {
    "even": lambda r: r.randint(1, 2048), "small": lambda r: r.randint(1, 60), "middle": lambda r: r.randint(300, 900), "one": lambda r: 700,
    "few": lambda r: r.choice([1, 20, 682, 683, 1000, 1049, 2048]), "third": lambda r: 500 if r.random() < 0.34 else r.randint(1, 2048),
}


@pytest.mark.parametrize("kind, ranges", [("even", 700), ("even", 1 << 16), ("small", 1 << 16), ("middle", 1 << 16), ("one", 300), ("few", 500), ("third", 900)])
def test_supersteps_pack_as_best_fit_decreasing(spark, monkeypatch, kind, ranges):
    """Every length gets a place, sequences have no holes, and there are at most one in a hundred more than best-fit decreasing opens."""
    monkeypatch.setattr(packing, "RANGE", ranges)
    r = random.Random(5)
    lengths = [LENGTHS[kind](r) for _ in range(2500)]
    scratch = Scratch(spark)
    out = packing.place(spark, scratch, scratch.table(spark.createDataFrame(list(enumerate(lengths)), "uid long, length int"))).collect()
    rows = defaultdict(list)
    for x in out:
        rows[x.seq].append((x.offset, lengths[x.uid]))
    assert sorted(x.uid for x in out) == list(range(len(lengths)))
    for row in rows.values():
        at = 0
        for offset, n in sorted(row):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(rows) <= 1.01 * brute.best_fit_decreasing(lengths, 2048) + 1


@pytest.mark.parametrize("seed", range(8))
def test_sweeps_over_ranges_match_what_one_sweep_matches(seed):
    """Pieces and slots along sizes are a sequence of brackets; ranges and the scan over them match the same brackets."""
    r = random.Random(seed)
    events = sorted((r.randrange(40) * 2 + piece, r.randrange(10**6), 1 if piece else r.randint(1, 3), piece) for piece in (r.random() < 0.5 for _ in range(60)))
    stack, want = [], {}
    for _, id_, many, piece in events:
        if not piece:
            stack += [id_] * many
        elif stack:
            want[id_] = stack.pop()
    cuts = sorted(r.sample(range(61), 5))
    got, left, pieces_, slots = {}, [], {}, {}
    for pid, (a, b) in enumerate(zip([0, *cuts], [*cuts, 60], strict=True)):
        part = events[a:b]
        batch = pa.RecordBatch.from_arrays([pa.array([pid] * len(part), pa.int32()), pa.array([x[0] for x in part], pa.int32()), pa.array([x[1] for x in part], pa.int64()), pa.array([x[2] for x in part], pa.int64()), pa.array([5] * len(part), pa.int32())], ["pid", "key", "id", "many", "size"])
        n = m = 0
        for out in packing._sweep(iter([batch])):
            for x in out.to_pylist():
                if x["uid"] is None:
                    slots |= {(pid, x["rank"] + k): x["seq"] for k in range(x["many"])}
                    m += x["many"]
                elif x["seq"] is None:
                    pieces_[pid, x["rank"]] = x["uid"]
                    n += 1
                else:
                    got[x["uid"]] = x["seq"]
        left.append((pid, n, m))
    for p, at, q, first, n in packing.across(left):
        got |= {pieces_[p, at + k]: slots[q, first + n - 1 - k] for k in range(n)}
    assert got == want


def test_packing(spark, data, odd):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").union(odd.dropDuplicates(["doc_id"]).selectExpr("doc_id + 100000", "text"))
    out = packing.pack(spark, docs, VOCABULARY, RANKS).collect()
    library = Tokenizer.from_file(VOCABULARY)
    by, rows = defaultdict(list), defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
        rows[r.sequence_id].append((r.offset, r.length))
    for d in docs.collect():
        every = [*library.encode(d.text or "", add_special_tokens=False).ids, 0]
        got = sorted(by[d.doc_id], key=lambda r: r.piece)
        assert [r.piece for r in got] == list(range(len(got))) and sum(r.length for r in got) == len(every) and all(r.length == 2048 for r in got[1:])
        for r in got:
            assert r.ids_crc32 == zlib.crc32(np.array(every[r.start : r.start + r.length], "<u4").tobytes())
    for row in rows.values():
        at = 0
        for offset, n in sorted(row):
            assert offset == at
            at += n
        assert at <= 2048
    assert len(rows) <= 1.02 * sum(r.length for r in out) / 2048 + 1


def test_packing_of_nothing(spark, empty):
    assert packing.pack(spark, empty, VOCABULARY, RANKS).count() == 0


@pytest.mark.parametrize("block", [1, 3, 4, 1000])
def test_token_files(spark, tmp_path, block):
    files = {"a": [5, 6, 2, 2, 7], "b": [], "c": [2], "d": [1] * 7, "e": [3] * 9 + [2] + [4] * 6 + [2], "f": [512, 2, 513]}
    want = []
    for name, data in files.items():
        np.array(data, "<u2").tofile(tmp_path / f"{name}.bin")
        at = no = 0
        while at < len(data):
            end = data.index(2, at) if 2 in data[at:] else len(data)
            want.append((f"{name}.bin", no, at, end - at, end < len(data)))
            at, no = end + 1, no + 1
    assert sorted(map(tuple, token_counts.count_tokens(spark, str(tmp_path), 2, block=block).collect())) == sorted(want)


def test_files_are_read_by_ranges(spark, tmp_path, monkeypatch):
    """No block carries a whole file, and a store that only Spark reads gives the same rows by the whole file."""
    r = random.Random(2)
    data = np.array([r.choice([2, 7, 9, 512]) for _ in range(20_001)], "<u2")
    (tmp_path / "a.bin").write_bytes(data.tobytes() + b"\x07")  # and half an identifier
    files = spark.read.format("binaryFile").load(str(tmp_path))
    parts = token_counts._blocks_of(files, 2, 1000).collect()
    assert sorted(x.block for x in parts) == list(range(21)) and max(len(x.data) for x in parts) == 2000
    assert b"".join(x.data for x in sorted(parts, key=lambda x: x.block)) == data.tobytes()
    by_place = sorted(map(tuple, token_counts.count_tokens(spark, str(tmp_path), 2, block=1000).collect()))
    monkeypatch.setattr(token_counts, "SEEKABLE", ("none",))
    assert sorted(map(tuple, token_counts.count_tokens(spark, str(tmp_path), 2, block=1000).collect())) == by_place and len(by_place) == (data == 2).sum() + (data[-1] != 2)


def test_long_units_are_cut_where_no_piece_spans():
    model, library = pieces.pieces(MODEL), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    r = random.Random(3)
    texts = ["".join(r.choice(letters) for _ in range(3000)) for letters in ("\u65e5\u672c\u8a9e\u3068\u4e2d", "abcxq0", "ab\u00e9Z#", "a")]
    assert [ids(x) for x in model.encode_batch(texts)] == [library.encode(t) for t in texts]
    assert max(map(len, model._parts(texts[2]))) < 3000 and "".join(model._parts(texts[2])) == texts[2]


def test_written_token_files(spark, tmp_path, odd, empty):
    token_counts.write_token_files(odd, MODEL, 2, str(tmp_path / "t"))
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = sorted(r.n_tokens for r in token_counts.count_tokens(spark, str(tmp_path / "t"), 2).collect())
    assert got == sorted(len(library.encode(r.text or "")) for r in odd.collect())
    token_counts.write_token_files(empty, MODEL, 2, str(tmp_path / "e"))
    assert token_counts.count_tokens(spark, str(tmp_path / "e"), 2).count() == 0
