from __future__ import annotations

import base64
import gzip
import hashlib
import zlib

import numpy as np
import pytest
import tokenizers
import zstandard
from pyspark.sql import functions as F

from orderloom.llm import lengths, tokenfile, warc
from orderloom.llm.bpe import Encoder, byte_bpe_path
from tests.llm.samples import clashing, documents, nothing, texts


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(byte_bpe_path())


def test_pieces_encode_like_whole_texts(library):
    odd = ["a  b", " a", "a ", "a\n b", "a \nb", "x  y", "x  y", "don't  we've", "<|endoftext|> a", "a <|endoftext|>", "1 2\t 3", "é 日本 語"]
    some = [t or "" for t in texts()] + odd
    encoder = Encoder(byte_bpe_path())
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(some)]
        assert got == [library.encode(t, add_special_tokens=False).ids for t in some]


@pytest.mark.parametrize("table", [documents, clashing])
def test_token_files_round_trip(spark, library, settings, table):
    settings(**{"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    docs = table(spark)
    files = tokenfile.write_token_files(docs.repartition(4), byte_bpe_path())
    rows = tokenfile.document_digests(files).orderBy("start").collect()
    order = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.doc_id for r in rows] == [r.doc_id for r in order]
    expected = sorted((-1 if r.doc_id is None else r.doc_id, ids_of(library, r.text)) for r in order)
    read = tokenfile.read_documents(files).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, np.frombuffer(r["ids"], "<u4").tolist()) for r in read)
    assert got == expected
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    sums = sorted((i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in expected)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == sums


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def test_reader_opens_only_what_it_needs(tmp_path, monkeypatch):
    monkeypatch.setattr(tokenfile, "FRAME_BYTES", 400)
    path = str(tmp_path / "x.tokens.zst")
    writer = tokenfile.Writer(path)
    documents_ = [np.arange(i % 70, dtype="<u4").tobytes() for i in range(100)]
    for ids in documents_:
        writer.add(ids)
    writer.close()
    reader = tokenfile.Reader(path)
    assert [x for _, x in reader.read()] == documents_
    reader = tokenfile.Reader(path)
    assert list(reader.read([50, 3])) == [(3, documents_[3]), (50, documents_[50])]
    assert reader.frames_read == 2 and len(reader.sizes) > 10
    with open(path, "rb") as f:
        data = bytearray(f.read())
    plain = zstandard.ZstdDecompressor().stream_reader(bytes(data), read_across_frames=True).read()
    assert plain == b"".join(documents_)
    data[reader.starts[5] + 12] ^= 1
    (tmp_path / "broken").write_bytes(data)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(tokenfile.Reader(str(tmp_path / "broken")).read())


def test_no_documents_no_files(spark):
    files = tokenfile.write_token_files(nothing(spark), byte_bpe_path())
    assert tokenfile.document_digests(files).count() == 0


def test_wanted_documents(spark, library):
    files = tokenfile.write_token_files(documents(spark), byte_bpe_path())
    wanted = spark.createDataFrame([(9,), (3,), (77,)], "doc_id bigint")
    rows = {r.doc_id: np.frombuffer(r["ids"], "<u4").tolist() for r in tokenfile.read_documents(files, wanted).collect()}
    assert rows == {i: ids_of(library, texts()[i]) for i in (3, 9)}


def test_length_histogram(spark, library):
    docs = documents(spark)
    sizes = [len(library.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect()]
    histogram = lengths.length_histogram(lengths.encoded_lengths(docs, byte_bpe_path(), ()))
    rows = histogram.collect()
    assert sorted(r.n_tokens for r in rows) == sorted(set(sizes))
    for r in rows:
        n = r.n_tokens
        fit = [x for x in sizes if x <= n]
        assert (r.n_docs, r.docs_up_to, r.tokens_up_to, r.docs_longer) == (sizes.count(n), len(fit), sum(fit), len(sizes) - len(fit))
        assert r.tokens_cut_at == sum(min(x, n) for x in sizes) and r.share_up_to == pytest.approx(len(fit) / len(sizes))
    limits = [0, 1, 100, 10**6]
    assert [tuple(r) for r in lengths.tokens_kept(histogram, limits).collect()] == [
        (x, sum(min(n, x) for n in sizes), sum(n > x for n in sizes)) for x in limits
    ]
    assert lengths.quantile(histogram, 0.5).first()[0] == sorted(sizes)[-(-len(sizes) // 2) - 1]
    empty = lengths.length_histogram(lengths.encoded_lengths(nothing(spark), byte_bpe_path()))
    assert empty.count() == 0 and lengths.quantile(empty, 0.5).first()[0] is None


@pytest.fixture
def pages(spark):
    long = "ü<p>" * 60_000
    rows = [(1, "http://a/1", "same"), (2, None, "same"), (3, "http://a/3 x\r\ny", "same"), (4, "u", None), (5, "u", ""), (6, "u", long),
            (7, "u", "other"), (7, "u", "other"), (None, "u", "same"), (-8, "u", long)]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id bigint, url string, html string, payload_bytes int, refers_to string")


@pytest.mark.parametrize("least", [0, 5])
def test_archives_round_trip(spark, pages, least):
    archives = warc.write_archives(pages, least_bytes=least, file_bytes=50_000)
    chunks = warc.read_chunks(spark, archives, chunk=1000).cache()
    rows = warc.page_digests(chunks).collect()
    source = pages.collect()
    payloads = [(r.page_id, (r.html or "").encode()) for r in source]
    expected = []
    for page, data in payloads:
        same = [i for i, d in payloads if d == data and i is not None]
        revisit = page is not None and len(data) >= least and page != max(same)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        expected.append((page, len(data), digest, "revisit" if revisit else "response", max(same) if revisit else None))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    assert chunks.where(F.length("data") > 1000).count() == 0
    for row in chunks.where("page_id = '6'").orderBy("chunk_no").collect():
        data = dict(payloads)[6]
        assert bytes(row.data) == data[row.chunk_start : row.chunk_start + 1000]
        assert base64.b32decode(row.digest) == hashlib.sha1(data[: row.chunk_start + len(row.data)]).digest()


def test_archives_are_plain_warc(spark, pages):
    for row in warc.write_archives(pages).collect():
        data = gzip.open(row.file.removeprefix("file://")).read()
        assert data.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        assert data.count(b"\r\n\r\nWARC/1.1\r\n") == row.records - 1


def test_no_pages(spark, pages):
    assert warc.page_digests(warc.read_chunks(spark, warc.write_archives(pages.limit(0)))).count() == 0


def test_files_are_read_back_by_many_tasks(spark, settings):
    """Lists of files are tiny, but adaptive execution must not read all files in one task."""
    settings(**{"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"})
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    files = tokenfile.write_token_files(docs, byte_bpe_path())
    pages = docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    archives = warc.write_archives(pages.repartition(16))
    settings(**{"spark.sql.adaptive.coalescePartitions.enabled": "true"})
    task = F.spark_partition_id().alias("task")
    assert files.index.select("file").distinct().count() > 8 and archives.count() > 8
    assert tokenfile.read_documents(files).select(task).distinct().count() > 4
    assert warc.read_chunks(spark, archives).select(task).distinct().count() > 4


def test_words_are_encoded_once_and_few_are_held(library, monkeypatch):
    """The library sees a word once, also when another task follows, until the cache is over its bound."""
    from orderloom.llm import bpe

    encoder, asked = Encoder(byte_bpe_path()), []
    batch = encoder.library.encode_batch_fast

    class Counting:
        def encode_batch_fast(self, texts, **options):
            asked.extend(texts)
            return batch(texts, **options)

    monkeypatch.setattr(encoder, "library", Counting())
    monkeypatch.setitem(bpe._loaded, "counted", encoder)
    texts = [" ".join(f"w{k}x{i}," for i in range(40)) + f"\nline{k} öäß. ends\nline{k}" for k in range(30)]
    plain = [np.array(library.encode(t, add_special_tokens=False).ids, np.uint32).tobytes() for t in texts]
    assert encoder.encode(texts) == plain and asked
    bpe.rest("counted")
    asked.clear()
    assert encoder.encode(texts[::-1]) == plain[::-1] and not asked
    monkeypatch.setattr(bpe, "CACHED", 100)
    for t, ids in zip(texts, plain):
        assert encoder.encode([t]) == [ids]
        bpe.rest("counted")
        assert len(encoder.cache.pieces) <= 100


def test_ids_are_put_together_in_steps(library, monkeypatch):
    """What is held beside a text's ids, in bytes of that text, stays small (pipeline, token-files)."""
    import tracemalloc

    from orderloom.llm import bpe

    encoder = bpe.Encoder(byte_bpe_path())
    text = " ".join(f"word{i % 997}" for i in range(300_000))
    encoder.encode([text])
    tracemalloc.start()
    try:
        encoder.encode([text])
        held = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert held < 10 * len(text)
    monkeypatch.setattr(bpe, "STEP", 3)
    few = ["one two three four five six seven eight nine", "", "a", "b c\nd", text[:500]]
    assert encoder.encode(few) == [np.array(library.encode(t, add_special_tokens=False).ids, np.uint32).tobytes() for t in few]
