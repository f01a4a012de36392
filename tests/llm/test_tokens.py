import hashlib
import zlib

import cases
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from orderlens.llm import bpe, byte_tokens, queries, token_counts, token_files
from orderlens.llm.common import LONGEST, int_lists
from orderlens.session import scratch_path

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
#: Letters that merge often, marks, spaces of many kinds, special tokens and other scripts.
TEXT = st.text(alphabet=st.one_of(st.sampled_from("aabtehin' s're\n \t\x1c\x85\xa0½²ªßÉΣİ́日😀<|>"), st.characters(
    exclude_categories=("Cs",), max_codepoint=0x2FFF)), max_size=60)


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(WORD), bpe.Encoder(WORD)


@pytest.fixture(scope="module")
def byte():
    return Tokenizer.from_file(BYTE), byte_tokens.ByteEncoder(BYTE)


def test_words_and_decoding(word):
    library, own = word

    @given(st.one_of(TEXT, st.just("x<|startoftext|>y <|endoftext|>")))
    @settings(max_examples=600, deadline=None)
    def same(text):
        ids = library.encode(text, add_special_tokens=False).ids
        made = int_lists([own.encode(text)])
        assert made.to_pylist() == [ids]
        assert own.decode(made).to_pylist() == [library.decode(ids, skip_special_tokens=False)]

    same()


def test_backtracking_on_long_words(word):
    library, own = word
    for text in ("a" * 3000, "ab" * 1500, "the" * 900, "ththethe" * 300, "".join(chr(97 + i * i % 26) for i in range(2000))):
        assert np.frombuffer(own.encode(text), "<i4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_small_caches_give_the_same(word):
    library, own = word
    own.words.limit = own.pairs.limit = 3
    text = cases.PROSE * 3
    assert np.frombuffer(own.encode(text), "<i4").tolist() == library.encode(text, add_special_tokens=False).ids
    own.words.limit, own.pairs.limit = bpe.WORDS, bpe.PAIRS


def test_byte_pieces(byte):
    library, own = byte

    @given(st.one_of(TEXT, st.just("a<|endoftext|> b")))
    @settings(max_examples=600, deadline=None)
    def same(text):
        assert np.frombuffer(own.encode(text), "<i4").tolist() == library.encode(text, add_special_tokens=False).ids

    same()


def test_encoding_edge_cases(spark, word):
    library, _ = word
    got = bpe.encode(cases.documents(spark), WORD, decoded=True)
    want = []
    for r in cases.rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], ids, library.decode(ids, skip_special_tokens=False)))
    assert cases.plain(got) == sorted(want, key=repr)
    assert cases.plain(bpe.decode(got, WORD)) == sorted(((a, c) for a, _, c in want), key=repr)
    assert bpe.encode(cases.empty(spark), WORD).collect() == []


def test_op1_on_the_table(spark, small, word):
    library, _ = word
    got = {r["doc_id"]: r for r in queries.op1_bpe(spark, small).collect()}
    rows = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = library.encode(r["text"], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["ids_sha256"], got[r["doc_id"]]["decoded_sha256"]) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest())


def test_token_files(spark, byte):
    library, _ = byte
    folder = scratch_path(spark, "token-files")
    token_files.write_tokens(cases.documents(spark), folder, BYTE)
    tokens = token_files.read_tokens(spark, folder)
    got = sorted(map(tuple, token_files.token_index(tokens).collect()), key=lambda r: r[1])
    lists = {}
    for r in cases.rows():
        lists.setdefault(r[0], []).append([*library.encode(r[1] or "", add_special_tokens=False).ids, 0])
    order = sorted(lists, key=lambda i: (i is not None, i))
    assert [r[0] for r in got] == [i for i in order for _ in lists[i]]
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1].tolist()]
    for doc_id in order:
        assert sorted(r[2:] for r in got if r[0] == doc_id) == sorted(
            (len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in lists[doc_id])
    assert tokens.filter("doc_id = 14").select("ids").first()[0] == lists[14][0]
    none = scratch_path(spark, "token-files")
    token_files.write_tokens(cases.empty(spark), none, BYTE)
    assert token_files.token_index(token_files.read_tokens(spark, none)).collect() == []


def test_token_files_have_bloom_filters_and_indexes(spark, small):
    """The written footers name the filter column; a pushed filter on doc_id is in the scan."""
    import glob

    import pyarrow.orc as orc
    folder = scratch_path(spark, "token-files")
    token_files.write_tokens(spark.read.parquet(f"{small}/documents.parquet"), folder, BYTE)
    file = orc.ORCFile(sorted(glob.glob(f"{folder.removeprefix('file:')}/*.orc"))[0])
    assert file.row_index_stride == 2000 and file.nstripes >= 1
    plan = token_files.read_tokens(spark, folder).filter("doc_id = 5")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,5)" in plan


def test_token_counts(spark, byte):
    library, _ = byte
    sums = token_counts.token_counts(cases.documents(spark), BYTE)
    sizes = np.array([len(library.encode(r[1] or "", add_special_tokens=False).ids) for r in cases.rows()])
    got = {r["n_tokens"]: r for r in sums.collect()}
    assert sorted(got) == sorted(set(sizes.tolist()))
    for n, r in got.items():
        assert (r["documents"], r["longer_documents"], r["longer_tokens"], r["total_tokens"], r["truncated_tokens"]) == (
            (sizes == n).sum(), (sizes > n).sum(), sizes[sizes > n].sum(), sizes.sum(), np.minimum(sizes, n).sum())
    for limit in (0, 1, 3, 30, 47, 100, 5000, 10 ** 6):
        assert token_counts.truncated_total(sums, limit).first()[0] == np.minimum(sizes, limit).sum()
    for share in (0.01, 0.25, 0.5, 0.9, 1.0):
        assert token_counts.quantile(sums, share).first()[0] == np.quantile(sizes, share, method="inverted_cdf")
    assert token_counts.token_counts(cases.empty(spark), BYTE).collect() == []


def test_two_level_sums_do_not_depend_on_the_bucket(spark):
    counted = spark.createDataFrame([(n, 1 + n % 5) for n in range(0, 400, 3)], "n_tokens long, documents long")
    assert cases.plain(token_counts.suffix_sums(counted, 7)) == cases.plain(token_counts.suffix_sums(counted, 10_000))


def test_files_go_by_their_number(spark):
    """Names pad numbers to five digits, so from 100,000 files on they are not in order of names."""
    names = [f"part-{n:05d}-abc.c000.orc" for n in (99_998, 99_999, 100_000, 100_001, 1_000_000)]
    frame = spark.createDataFrame([(n,) for n in names], "part string")
    assert [r["part"] for r in frame.orderBy(token_files.file_number(F.col("part"))).collect()] == names
    assert [r["part"] for r in frame.orderBy("part").collect()] != names


def test_long_words_are_not_remembered():
    """Caches hold short texts only: a few hundred words of 100,000 letters leave no trace in them."""
    tools = bpe.Encoder(WORD), byte_tokens.ByteEncoder(BYTE)
    for n in range(20):
        for tool in tools:
            tool.encode(f"{'abcdefghij'[n % 10] * 20_000}{n} short{n}")
    for cache in (tools[0].words, tools[0].others, tools[1].known):
        assert all(len(key) <= LONGEST for key in cache)
    assert 1 < len(tools[0].words) < 100 and 1 < len(tools[1].known) < 100
