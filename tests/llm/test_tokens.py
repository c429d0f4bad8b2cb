"""Token files against the tokenizer itself: exact round trips, order, edge cases."""

import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from paceframe.llm import queries, token_codec, tokens

PATH = public_tokenizers.path(queries.VOCABULARY)
TOOL = Tokenizer.from_file(PATH)
TOOL.encode_special_tokens = True
PIECES = tokens.PieceCoder(TOOL, np.dtype("<u2"), "test")
SCHEMA = "doc_id long, text string, ids string, part int, n long"
ROWS = [
    (7, "plain words, plain words", "x", 1, 1), (None, "no id", "x", 1, 1), (3, None, None, None, None), (5, "", "x", 1, 1),
    (3, "a second row of three", "x", 1, 1), (7, "plain words, plain words", "x", 1, 1), (-2, "naïve 漢字 🙂 <|endoftext|> !", "x", 1, 1),
    (9, "long " * 30_000, "x", 1, 1),
]


def expected(rows, end=0):
    tool = Tokenizer.from_file(PATH)
    tool.encode_special_tokens = True
    at, out = 0, []
    for doc, text in rows:
        ids = tool.encode(text or "", add_special_tokens=False).ids + ([] if end is None else [end])
        out.append((doc, at, len(ids), ids))
        at += len(ids)
    return out


def collected(df):
    return sorted(
        ((r["doc_id"], r["start"], r["n_tokens"], np.frombuffer(r["ids"], dtype="<u4").tolist()) for r in df.collect()),
        key=lambda r: r[1],
    )


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(65_000, 66_000), st.integers(0, 2**32 - 1)), max_size=50))
def test_codec_round_trip(numbers):
    x = np.array(numbers, dtype=np.uint32)
    control, data = token_codec.encode(x)
    assert len(control) == -(-len(x) // 4)
    assert len(data) == sum(max(1, (int(v).bit_length() + 7) // 8) for v in x)
    assert np.array_equal(token_codec.decode(control, data, len(x)), x)


def test_codec_refuses_cut_data():
    control, data = token_codec.encode(np.array([1, 70_000], dtype=np.uint32))
    with pytest.raises(ValueError):
        token_codec.decode(control, data[:-1], 2)


TEXT = st.text(st.one_of(st.sampled_from(" \n\t\r'sdlrvtm0aZ.,!é漢\u00a0\u0085\u2003\x1c\x1f\x00"), st.characters(codec="utf-8")), max_size=60)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_pieces_encode_as_whole_texts(texts):
    kind = np.dtype("<u2")
    assert PIECES.encode(texts) == tokens.WholeCoder(TOOL, kind).encode(texts)
    assert all("".join(tokens.PieceCoder.pieces(t)) == t for t in texts)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t'.-<saZ0é×«漢\u00a0\u0085\u2009\u3000\u0301\x1c"), max_size=40), max_size=6))
def test_forgotten_and_joined_pieces(texts):
    small = tokens.PieceCoder(TOOL, np.dtype("<u2"), "small")
    small.LIMIT, small.JOINED = 50, 3
    whole = tokens.WholeCoder(TOOL, np.dtype("<u2"))
    assert small.encode(texts) == whole.encode(texts)
    # slices of a column with either width of offsets
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(["left out", *texts, "left out"], kind).slice(1, len(texts))
        for found, want in zip(small.column(column), whole.column(column)):
            assert np.array_equal(found, want)


def test_new_pieces_share_calls_of_the_library():
    class Counted:
        items = 0

        def __getattr__(self, name):
            return getattr(TOOL, name)

        def encode_batch_fast(self, texts, **options):
            self.items += len(texts)
            return TOOL.encode_batch_fast(texts, **options)

    tool = Counted()
    texts = [" ".join(f"w{chr(97 + i % 26)}{i:x}" for i in range(k, k + 1000)) + ".\nEnd\tof it " for k in range(0, 9000, 500)]
    coder = tokens.PieceCoder(tool, np.dtype("<u2"), "counted")
    want = tokens.WholeCoder(TOOL, np.dtype("<u2")).encode(texts)
    assert coder.encode(texts) == want
    assert tool.items < 20  # 9,500 different words
    before = tool.items
    assert coder.encode(texts) == want and tool.items == before


def test_vocabularies_without_all_bytes_stay_whole():
    with open(PATH, encoding="utf-8") as f:
        d = json.load(f)
    del d["model"]["vocab"]["!"]
    assert not tokens.cuts_at_spaces(json.dumps(d))


def test_other_vocabularies_stay_whole():
    with open(PATH, encoding="utf-8") as f:
        assert tokens.cuts_at_spaces(f.read())
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        assert not tokens.cuts_at_spaces(f.read())


@pytest.mark.parametrize("block", [1 << 20, 16])
def test_edge_rows(spark, monkeypatch, block):
    monkeypatch.setattr(tokens, "BLOCK_IDS", block)
    monkeypatch.setattr(tokens, "FILE_IDS", 8 * block)
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = collected(tokens.round_trip(df, PATH))
    # rows of one id stand in the order of the digest of their text
    keyed = spark.createDataFrame(ROWS, SCHEMA).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = [tuple(r) for r in keyed.orderBy(F.asc_nulls_first("doc_id"), F.xxhash64("text")).collect()]
    assert got == expected(ordered)


def test_empty_table_and_no_end_id(spark):
    assert tokens.round_trip(spark.createDataFrame([], SCHEMA), PATH).collect() == []
    df = spark.createDataFrame(ROWS[:4], SCHEMA)
    got = collected(tokens.round_trip(df, PATH, end=None))
    assert sorted((d is not None, d or 0, i) for d, _, _, i in got) == sorted((d is not None, d or 0, i) for d, _, _, i in expected([r[:2] for r in ROWS[:4]], None))


def test_frequent_ids_have_small_ranks_and_files_are_checked(spark, tmp_path):
    df = spark.createDataFrame([(i, "the the the the of " + "zq" * (i % 3)) for i in range(50)], "doc_id long, text string")
    path = str(tmp_path / "set")
    tokens.write(df, path, PATH)
    ids = np.frombuffer((tmp_path / "set" / "ids.bin").read_bytes(), dtype="<u4")
    counts = dict(zip(*np.unique(np.concatenate([i for _, _, _, i in collected(tokens.read(spark, path))]), return_counts=True)))
    assert ids.tolist() == sorted(counts, key=lambda i: (-counts[i], i))
    manifest = json.loads((tmp_path / "set" / "manifest.json").read_text())
    assert sum(f["docs"] for f in manifest["files"]) == 50 and manifest["ids"] == sum(counts.values())
    # a file that the manifest does not name is no part of the dataset
    (tmp_path / "set" / "lost.tok").write_bytes(b"junk")
    assert tokens.read(spark, path).count() == 50
    file = tmp_path / "set" / manifest["files"][0]["name"]
    file.write_bytes(file.read_bytes()[:-1] + b"\xff")
    with pytest.raises(Exception, match="damaged"):
        tokens.read(spark, path).collect()


def test_registered_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    want = [
        (d, s, n, zlib.crc32(np.array(i, dtype="<u4").tobytes())) for d, s, n, i in expected([(r["doc_id"], r["text"]) for r in docs])
    ]
    got = queries.QUERIES["op11_token_output"](spark, folder)
    assert got.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert sorted(tuple(r) for r in got.collect()) == want
