"""Pieces, archives, packing and dialogues: round trips and brute force."""

import gzip
import io
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillmetrics.llm import packing, perspectives, pieces, queries, warc
from tillmetrics.llm.arrays import text_blocks

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = [None, "", " ", "  two  spaces ", "▁mark", "a\nb\tc", "中文 😀 é", "<|endoftext|> x", "word " * 4000, "x" * 3000]


def plain_viterbi(text, model):
    """Best score of the text's segmentations, and every id sequence that has it is as good."""
    text = " " + text.replace("▁", " ") if text else ""
    score = {}
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            score[model.id_to_piece(i).replace("▁", " ")] = (model.get_score(i), i)
    unknown = min(s for s, _ in score.values()) - 10
    best = [(0.0, 0, [])] + [None] * len(text)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - 48), end):
            part = text[begin:end]
            if part in score:
                s, ids = score[part][0], [score[part][1]]
            elif end - begin == 1:
                s, ids = unknown, [model.piece_to_id(f"<0x{b:02X}>") for b in part.encode()]
            else:
                continue
            total = best[begin][0] + s
            if best[end] is None or total > best[end][0]:
                best[end] = (total, begin, ids)
    out, end = [], len(text)
    while end:
        out = best[end][2] + out
        end = best[end][1]
    return out


def block_ids(values, encoder):
    out = []
    for _, _, block in text_blocks(pa.array([" " + v.replace("▁", " ") if v else "" for v in values])):
        ids, bounds = encoder.encode(block)
        out += [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    return out


def test_pieces_match_plain_viterbi():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(1)
    values = ["".join(rng.choice("theandion  é中\n,.ABCxyz12") for _ in range(rng.randint(0, 25))) for _ in range(60)]
    values += ["hello world and the other words", "  lead", "trail  ", "ﬁ ligature 😀😀"]
    encoder = pieces.Encoder(MODEL)
    got = block_ids(values, encoder)
    assert got == [plain_viterbi(v, model) for v in values]
    assert [model.decode(g) for g in got] == values


def test_pieces_score_as_the_library_s_lattice(spark):
    """The library, told to take the pieces as a unigram model, finds no better path in its lattice."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    lines = [x[:120] for r in rows for x in r.text.split("\n") if x][:300]

    def score(ids):
        return sum(library.get_score(int(i)) for i in ids)

    compared = 0
    for line, ids in zip(lines, block_ids(lines, pieces.Encoder(MODEL)), strict=True):
        theirs = score(library.nbest_encode_as_ids(line, 2)[0])
        if theirs > -1e7:  # beyond it the library's 32-bit sums are not exact
            assert score(ids) == theirs
            compared += 1
    assert compared > 150


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
def test_pieces_round_trip(values):
    encoder = pieces.Encoder(MODEL)
    got = block_ids(values, encoder)
    bounds = np.append(0, np.cumsum([len(g) for g in got]))
    data, ends = pieces.decode_bytes(np.array([i for g in got for i in g], np.int64), bounds, encoder.pieces)
    back = [data.tobytes()[a:b].decode() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert back == [v.replace("▁", " ") for v in values]


def test_pieces_frames(spark, texts):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(2, ODD[2]), (None, "x")]
    encoded = pieces.encode(texts(rows), MODEL)
    got = encoded.collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    for r in got:
        assert r.n_ids == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    back = {r.doc_id: r.text for r in pieces.decode(encoded, MODEL).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(ODD))
    assert pieces.encode(texts([]), MODEL).count() == 0
    nulls = encoded.selectExpr("doc_id", "cast(null as array<int>) as ids")
    assert {r.text for r in pieces.decode(nulls, MODEL).collect()} == {None}
    own = [i for r in encoded.collect() if r.doc_id is not None for i in (r.ids or [])][:5]
    odd = [(1, [-1, *own, 10**6]), (2, [None, *own]), (3, own), (4, []), (5, [-1])]
    given = spark.createDataFrame([(*row, "x") for row in odd], "doc_id long, ids array<int>, text string")
    texts_of = {r.doc_id: r.text for r in pieces.decode(given, MODEL).collect()}
    assert texts_of[1] == texts_of[2] == texts_of[3] and texts_of[4] == texts_of[5] == ""
    assert pieces.decode(given.limit(0), MODEL).count() == 0


def test_long_chunk_and_forgetting(monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    encoder = pieces.Encoder(MODEL)
    values = [f"word{i} and" for i in range(50)]
    once = [block_ids([v], encoder)[0] for v in values]
    assert once == block_ids(values, pieces.Encoder(MODEL))


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_the_library_s(text):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BPE)
    for t in (text, f"{text} it's  the\n\n END 12", f"x{text}<|endoftext|>"):
        assert packing.encode(t, BPE) == whole.encode(t, add_special_tokens=False).ids


def test_ids_of_benchmark_texts(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BPE)
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert packing.encode(r.text, BPE) == whole.encode(r.text, add_special_tokens=False).ids


def test_differencing_is_a_partition_with_small_spread():
    rng = np.random.default_rng(0)
    sizes = rng.integers(1, 256, 400)
    sums = np.bincount(packing.differencing(sizes, 20), weights=sizes, minlength=20)
    assert sums.sum() == sizes.sum() and sums.max() - sums.min() <= 3
    # The textbook case: 8, 7, 6, 5, 4 differ by two.
    sums = np.bincount(packing.differencing(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])
    assert sorted(sums) == [14, 16]


def test_window_count_rises_over_capacity():
    window = packing.fill_windows(np.array([600, 600, 600]), 1024)
    assert len(set(window.tolist())) == 3
    assert len(packing.fill_windows(np.zeros(0, np.int64), 1024)) == 0


def test_packing(spark, texts, monkeypatch):
    monkeypatch.setattr(packing, "LOT_PARTS", 40)
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(100 + i, " ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(1, 900)))) for i in range(120)]
    rows += [rows[3], (None, "no id")]
    got = packing.pack(texts(rows), BPE, with_ids=True).collect()
    by_doc, by_window = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_window.setdefault(r.sequence_id, []).append(r)
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(BPE)
    for i, text in dict(rows).items():
        parts = sorted({r.start: r for r in by_doc[i]}.values(), key=lambda r: r.start)
        ids = [x for r in parts for x in r.ids]
        assert ids == [*whole.encode(text or "", add_special_tokens=False).ids, 0]
        assert {r.doc_tokens for r in parts} == {len(ids)}
    assert len(by_doc[3]) == 2
    for parts in by_window.values():
        parts.sort(key=lambda r: r.offset)
        assert [r.offset for r in parts] == [sum(p.length for p in parts[:k]) for k in range(len(parts))]
        assert sum(r.length for r in parts) <= 1024
    total = sum(r.length for r in got)
    assert total / (1024 * len(by_window)) > 0.93
    assert packing.pack(texts([]), BPE).count() == 0


def test_one_id_does_not_fill_a_lot(texts, monkeypatch):
    monkeypatch.setattr(packing, "LOT_PARTS", 40)
    rows = [(None, f"no id {i}") for i in range(400)] + [(7, "seven")] * 400
    got = packing.pack(texts(rows), BPE).collect()
    assert sum(r.doc_id is None for r in got) == sum(r.doc_id == 7 for r in got) == 400
    lots = {}
    for r in got:
        lots[r.sequence_id >> 32] = lots.get(r.sequence_id >> 32, 0) + 1
    assert max(lots.values()) < 100


def test_sequences_hold_all_ids(texts):
    rows = [(i, f"some words {i} " * (i * 9)) for i in range(40)]
    packed = packing.pack(texts(rows), BPE, with_ids=True).cache()
    whole = packing.sequences(packed).collect()
    assert sum(r.n_ids for r in whole) == packed.selectExpr("sum(length) as n").first().n
    assert all(len(r.ids) == 1024 or len(r.ids) == r.n_ids for r in whole)


PAGES = [
    (3, "http://a/x", "<p>same</p>"),
    (1, "http://a/y", "<p>same</p>"),
    (2, None, None),
    (7, "http://a/\r\nz", ""),
    (9, "http://a/long", "é" * 200_000),
    (10, "http://a/crlf", "\r\n\r\nWARC/1.1\r\n"),
    (None, "http://a/n", "<p>same</p>"),
    (1, "http://a/y", "<p>same</p>"),
]


def test_archives_round_trip(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 400)
    pages = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, path string")
    marked = warc.mark_revisits(pages)
    manifest = warc.write_archives(marked, f"file://{tmp_path}/archives")
    assert manifest.count() > 1
    got = warc.read_archives(manifest, keep_payload=True).collect()
    assert len(got) == len(PAGES) and all(r.digest_ok for r in got)
    first = {"<p>same</p>": 1, "": 2}
    for i, _, html in PAGES:
        html = html or ""
        for r in (r for r in got if r.page_id == i and (i is not None or r.url.endswith("n"))):
            refers = first.get(html) if i is not None and first.get(html, i) < i else None
            assert (r.record_type, r.refers_to) == ("response" if refers is None else "revisit", refers)
            assert r.payload_bytes == len(html.encode())
            assert r.payload_digest == warc.base32_sha1(html.encode())
            assert r.payload == (html.encode() if refers is None else b"")
    small = warc.archive_and_read(pages, min_bytes=5).filter("page_id in (2, 7)").collect()
    assert {r.record_type for r in small} == {"response"}
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_reader_is_sequential_and_strict():
    data = warc.record(1, "http://a", b"x" * 300_000, None) + warc.record(2, "http://b", b"y", 1)
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 2
    found = list(warc.read_records(io.BytesIO(data), keep_payload=True))
    assert [r["warc-type"] for r in found] == ["response", "revisit"]
    assert found[1]["warc-refers-to"] == found[0]["warc-record-id"]
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(data[:-9])))
    raw = gzip.decompress(warc.record(1, "http://a", b"payload", None))
    wrong = gzip.compress(raw.replace(b"payload", b"pAyload"))
    assert [r["digest_ok"] for r in warc.read_records(io.BytesIO(wrong))] == [False]
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(raw + b"more"))))


def test_very_long_url():
    url = "http://a/" + "".join(chr(97 + i * i % 23) for i in range(3 << 20))
    data = warc.record(1, url, b"x", None) + warc.record(2, "http://b", b"y", None)
    found = list(warc.read_records(io.BytesIO(data), keep_payload=True))
    assert [r["warc-target-uri"] for r in found] == [url, "http://b"]
    assert [r["payload"] for r in found] == [b"x", b"y"] and all(r["digest_ok"] for r in found)
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(gzip.compress(b"WARC/1.1\r\nX: " + b"x" * 100_000))))


def plain_dialogue(turns, who):
    text, spans = "", []
    key = lambda t: (t[0] is not None, t[0] or 0, t[1] is not None, t[1] or "", t[2] or "")
    for _, role, body in sorted(turns, key=key):
        body = (body or "").replace("<|", "< |")
        if role == who:
            text += "<|assistant|>\n"
            spans.append((len(text), len(text) + len(body) + 8))
        elif role == "system":
            text += "<|system|>\n"
        else:
            text += f"<|user name={(role or 'unknown').replace('<|', '< |')}|>\n"
        text += f"{body}<|end|>\n"
    return text, spans


def test_perspectives(spark, monkeypatch):
    monkeypatch.setattr(perspectives, "PART_TURNS", 4)
    rng = random.Random(6)
    rows = []
    for conv in range(12):
        people = ["ann", "bob", "<|user", "system"][: rng.randint(1, 4)]
        rows += [(conv, t, rng.choice(people), rng.choice(["hi", "", None, "<|end|> x", "é 😀"])) for t in range(rng.randint(1, 11))]
    rows += [(50, 0, "ann", "a"), (50, 0, "ann", "a"), (50, None, "bob", "n"), (50, 1, None, "who"), (None, 0, "ann", "x")]
    rows += [(51, 0, "system", "only")]
    frame = spark.createDataFrame(
        [(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, part int, segment string"
    ).repartition(3)
    seg = perspectives.segments(frame)
    parts = {}
    for r in perspectives.render(seg).collect():
        parts.setdefault((r.conv_id, r.perspective), []).append(r)
    want = {}
    for conv in {r[0] for r in rows if r[0] is not None}:
        turns = [r[1:] for r in rows if r[0] == conv]
        for who in {t[1] for t in turns if t[1] not in (None, "system")}:
            want[conv, who] = plain_dialogue(turns, who)
    assert set(parts) == set(want)
    for key, pieces_of in parts.items():
        pieces_of.sort(key=lambda r: r.part)
        assert "".join(r.text for r in pieces_of) == want[key][0]
        assert [tuple(s) for r in pieces_of for s in r.loss_spans] == want[key][1]
    for r in perspectives.digest(seg).collect():
        text, spans = want[r.conv_id, r.perspective]
        assert (r.n_chars, r.n_loss_chars) == (len(text), sum(b - a for a, b in spans))
    assert perspectives.segments(frame.limit(0)).count() == 0


def test_dialogues_read_back(spark, monkeypatch):
    monkeypatch.setattr(perspectives, "PART_TURNS", 4)
    monkeypatch.setattr(perspectives, "PART_CHARS", 60)
    people = ["ann", "bob<", "", "<|end|>\n", "system", None]
    texts = ["hi", "", None, "<|end|>\n", "<|assistant|>\nx", "<", "|end|>\n", "é 😀" * 40]
    rng = random.Random(8)
    rows = [(c, rng.choice([None, *range(9)]), rng.choice(people), rng.choice(texts)) for c in range(9) for _ in range(c)]
    rows += [(20, 1, "ann", "same")] * 30
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    seg = perspectives.segments(frame)
    texts = perspectives.render(seg)
    assert set(perspectives.digest_texts(texts).collect()) == set(perspectives.digest(seg).collect())
    dialogues = {}
    for r in sorted(texts.collect(), key=lambda r: r.start):
        said, spans = dialogues.get((r.conv_id, r.perspective), ("", []))
        assert r.start == len(said) and r.text
        dialogues[r.conv_id, r.perspective] = (said + r.text, spans + [tuple(s) for s in r.loss_spans])
    assert texts.filter("conv_id = 20").count() > 1
    assert set(dialogues) == {tuple(r) for r in perspectives.digest(seg).select("conv_id", "perspective").collect()}
    assert dialogues[20, "ann"] == plain_dialogue([(1, "ann", "same")] * 30, "ann")
    assert perspectives.digest_texts(texts.limit(0)).count() == 0


def test_chat_query_digests_the_rendered_texts(spark, monkeypatch):
    path = "/root/testdata/sf0.001"
    render, before = perspectives.render, queries.op8_chat_formatting(spark, path).collect()
    for change in ({"text": F.replace("text", F.lit("e"), F.lit("E"))}, {"loss_spans": F.slice("loss_spans", 1, 1)}):
        monkeypatch.setattr(perspectives, "render", lambda seg, change=change: render(seg).withColumns(change))
        after = queries.op8_chat_formatting(spark, path).collect()
        assert len(after) == len(before) and set(after) != set(before)
