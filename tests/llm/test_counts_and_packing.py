import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hardcourt.llm import media_avi, packing, token_counts
from tests.llm.fixtures import SF, docs

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_token_counts(spark):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for df in (table(spark).select("doc_id", "text"), docs(spark, clash=True)):
        want = sorted((r.doc_id or 0, len((r.text or "").encode()), n := len(sp.encode(r.text or "")), n > 4096) for r in df.collect())
        assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(df, PIECES).collect()) == want
    assert token_counts.token_counts(docs(spark, rows=[]), PIECES).count() == 0


def test_counts_do_not_hang_on_the_table(spark, monkeypatch):
    monkeypatch.setattr(token_counts, "SAMPLE", 30)
    monkeypatch.setattr(token_counts, "TABLE", 40)
    monkeypatch.setattr(token_counts, "SUMMARY", 20)
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df = table(spark).select("doc_id", "text")
    words = token_counts.frequent_words(df.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "doc_id")
    assert 0 < len(words) <= 40
    assert {r.doc_id: r.n_tokens for r in token_counts.token_counts(df, PIECES).collect()} == {r.doc_id: len(sp.encode(r.text or "")) for r in df.collect()}


def test_few_jobs_for_many_partitions(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"word{i % 50} and more text here") for i in range(640)], "doc_id long, text string")
    rows.repartition(64).write.parquet(f"{tmp_path}/t")
    df = spark.read.option("maxPartitionBytes", 1).parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    spark.sparkContext.setJobGroup("counts", "counts")
    try:
        assert df.rdd.getNumPartitions() >= 64
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counts"))
        got = token_counts.token_counts(df, PIECES)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("counts")) - before <= 5
    finally:
        spark.sparkContext.setJobGroup("", "")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got.count() == 640


def test_words_add_up():
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert not [p for p in (sp.id_to_piece(i) for i in range(sp.vocab_size())) if "▁" in p.lstrip("▁")]


def check_packing(pieces, ids, capacity=packing.CAPACITY, segments=packing.MAX_SEGMENTS):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for doc, rows in by_doc.items():
        at = 0
        for r in sorted(rows, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids[doc])) and r.ids_crc32 == zlib.crc32(ids[doc][at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids[doc])
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and len(rows) <= segments
        assert at == capacity or at & (at - 1) == 0  # no padding
    return by_sequence


def test_packing(spark):
    tok = Tokenizer.from_file(packing.tokenizer_path())
    unique = [r for k, r in enumerate(docs(spark).collect()) if k != 9 and r.doc_id is not None]
    for df in (table(spark), docs(spark, rows=[tuple(r) for r in unique])):
        ids = {r.doc_id: np.array(tok.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4") for r in df.collect()}
        check_packing(packing.packed(packing.whole_documents(df), packing.tokenizer_path()).collect(), ids)
    assert packing.packed(packing.whole_documents(docs(spark, rows=[])), packing.tokenizer_path()).count() == 0
    assert packing.packed(packing.whole_documents(docs(spark, clash=True)), packing.tokenizer_path()).count() >= len(docs(spark).collect())


def test_packing_keeps_every_limit(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = packing.packed(packing.conversations(turns), packing.tokenizer_path(), key="conv_id", capacity=256, segments=4, loss=100).collect()
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    for s in sequences.values():
        assert sum(r.length for r in s) <= 256 and len(s) <= 4 and sum(r.loss_tokens for r in s) <= 100
    assert {r.conv_id for r in rows} == {r.conv_id for r in turns.select("conv_id").distinct().collect()}


def test_all_limits_bind_for_instruction_data(spark):
    sequences = defaultdict(list)
    for r in packing.packed_conversations(spark, SF).collect():
        sequences[r.sequence_id].append(r)
    tokens, segments, loss = ([f(s) for s in sequences.values()] for f in (lambda s: sum(r.length for r in s), len, lambda s: sum(r.loss_tokens for r in s)))
    assert max(tokens) <= packing.CAPACITY and max(segments) <= packing.MAX_SEGMENTS and max(loss) == packing.MAX_LOSS


def test_conversations_null_long_and_clashing(spark, monkeypatch):
    monkeypatch.setattr(packing, "RUN", 3)
    rows = [("a", k, "user" if k % 2 else "assistant", f"t{k}") for k in range(5)] + [("a", 1, "user", "t1"), ("a", None, "user", None), (None, 7, "assistant", "x"), (None, 7, "assistant", "x"), ("b", 2, None, "y")]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string").select("*", F.lit(1).alias("TEXT"), F.lit(2).alias("parts"))
    got = sorted((r.conv_id or "", [(p.text, p.loss) for p in r.parts]) for r in packing.conversations(df).collect())
    assert got == [
        ("", [("x", True)]), ("", [("x", True)]),
        ("a", [("", False), ("t0", True), ("t1", False), ("t1", False), ("t2", True)]), ("a", [("t3", False), ("t4", True)]), ("b", [("y", False)]),
    ]
    assert packing.conversations(df.limit(0)).count() == 0


def test_word_ids_equal_the_tokenizers():
    ids = packing.ids_of(packing.tokenizer_path())
    for t in ("a  b", "a   b ", "\n x \n y", "é ª º µm ×x", " lead", "trail ", "x<|endoftext|>y", "it's 'tis don't.", " . , ..", "naïve, Ωmega. 漢字 테스트,", "a.\nB c.\n\nd", "x \ny\n", "\n \n", "１２ ¼", "q.\n", " \nq\n r", "a\0b c", "a\tb c", "end ", "a\x1c b", "two  spaces in", "x " * 50):
        assert ids.of(t) == np.array(ids.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), t


def test_media_round_trip(spark):
    raw = [bytes(i % 256 for i in range(k, k + 64 * n)) for k, n in ((0, 1), (3, 16), (9, 5))] + [b"\xff\x00" * 32, b"\0" * 64, b"\xff" * 64]
    assert media_avi.decode_frames(media_avi.encode_frames(raw)) == raw
    for df in (table(spark), docs(spark, clash=True)):
        got = media_avi.read_media(media_avi.media_column(df))
        want = sorted((r.doc_id or 0, len((r.text or "").encode()), hashlib.sha256(media_avi.payload_of(r.text)[1]).hexdigest(), zlib.crc32(media_avi.payload_of(r.text)[1][-64:])) for r in df.collect())
        assert sorted((r.doc_id or 0, r.n_bytes, r.payload_sha256, r.tail_crc32) for r in got.collect()) == want
        clips = media_avi.clip_rows(got).collect()
        assert all(r.start_ms < r.end_ms for r in clips) and len(clips) >= df.count()
    assert media_avi.read_media(media_avi.media_column(docs(spark, rows=[]))).count() == 0
    bad = spark.createDataFrame([(1, bytearray(b"RIFFxxxxAVI ")), (2, None)], "doc_id long, media binary")
    assert [(r.payload_bytes, r.clips) for r in media_avi.read_media(bad).collect()] == [(None, None)] * 2


def test_shots_and_index():
    dark, light = bytes(1024), bytes([200] * 1024)
    assert media_avi.shots([dark] * 5 + [light] * 4 + [dark]) == [(0, 5), (5, 9), (9, 10)]
    frames = media_avi.encode_frames([dark, light])
    movie = media_avi.avi(frames, 16, 2000)
    assert media_avi.riff_parts(movie) == (frames, 2000, media_avi.FRAME_MS)
    cut = movie[: movie.index(b"idx1")]
    assert media_avi.riff_parts(cut)[0] == frames


def decoded_by_force(jpeg):
    """A lossless frame of one component, predictor 1, read bit by bit as the standard says."""
    at, codes, data = 2, {}, b""
    while at < len(jpeg):
        marker, size = jpeg[at + 1], int.from_bytes(jpeg[at + 2 : at + 4], "big")
        body = jpeg[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xC3:
            lines, width = int.from_bytes(body[1:3], "big"), int.from_bytes(body[3:5], "big")
        elif marker == 0xC4:
            code, k = 0, 17
            for length in range(1, 17):
                for _ in range(body[length]):
                    codes[(length, code)] = body[k]
                    code, k = code + 1, k + 1
                code <<= 1
        elif marker == 0xDA:
            data = jpeg[at:]
            break
    out, line, k = [], b"", 0
    while len(out) < lines:
        if data[k] == 0xFF and data[k + 1]:
            bits = "".join(f"{b:08b}" for b in line)
            row, past, place = [], 128, 0
            for _ in range(width):
                length = next(n for n in range(1, 17) if (n, int(bits[place : place + n], 2)) in codes)
                size = codes[(length, int(bits[place : place + length], 2))]
                place += length
                value = int(bits[place : place + size] or "0", 2)
                place += size
                past += value if not size or value >> (size - 1) else value - (1 << size) + 1
                row.append(past % 65536)
            out.append(bytes(row))
            line, k = b"", k + 2
        else:
            line, k = line + data[k : k + 1], k + (2 if data[k] == 0xFF else 1)
    return b"".join(out)


def test_frames_by_force():
    raw = [hashlib.sha512(bytes([k])).digest() * (1 + k % 3) for k in range(6)] + [b"\xff\x00" * 32, b"text of a page. " * 8]
    for frame, jpeg in zip(raw, media_avi.encode_frames(raw), strict=True):
        assert decoded_by_force(jpeg) == frame


def test_shots_by_force(spark):
    def by_force(frames):
        hist = [[sum(b // 16 == k for b in f) / len(f) for k in range(16)] for f in frames]
        change = [sum(abs(a - b) for a, b in zip(x, y, strict=True)) for x, y in zip(hist, hist[1:], strict=False)]
        cuts = []
        for i, c in enumerate(change):
            before = change[max(0, i - media_avi.BEFORE) : i]
            mean = sum(before) / max(1, len(before))
            spread = (sum(b * b for b in before) / max(1, len(before)) - mean * mean) if before else 0
            if c > max(media_avi.FLOOR, mean + media_avi.DEVIATIONS * max(0, spread) ** 0.5):
                cuts.append(i + 1)
        edges = [0, *cuts, len(frames)]
        return list(zip(edges, edges[1:], strict=False))

    got = {r.doc_id: r for r in media_avi.op8_avi_media(spark, SF).collect()}
    size = media_avi.WIDTH * media_avi.HEIGHT
    for r in table(spark).filter("doc_id < 60").collect():
        payload = media_avi.payload_of(r.text)[1]
        frames = [payload[k : k + size].ljust(size, b"\0") for k in range(0, len(payload), size)]  # the last one is filled
        want = ",".join(f"{a * media_avi.FRAME_MS}-{b * media_avi.FRAME_MS}" for a, b in by_force(frames))
        assert got[r.doc_id].feature == want, r.doc_id
        assert got[r.doc_id].media_bytes > len(payload) // 8 and len(got[r.doc_id].media_sha256) == 64
