"""Token records and merge-dropout: exact round trips, and the libraries' own encoders; the pipeline."""

import random
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from broadsheet.llm import records
from broadsheet.llm.common import new_path
from broadsheet.llm.merges import DropoutEncoder, MergeModel, agenda, decode_documents, encode_documents, encoded_digests
from broadsheet.llm.mixing import mix
from tests.llm.test_pair_ops import jaccard_plain
from tests.llm.test_text_ops import lines_plain

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "a", "  a  b ", "\n\n x\n", "tab\tx  y\n\nz  \n", "日本語 テキスト 😀", "x" * 300, "ab " * 3 + "\n", "a\n  b", "x \n y", "q 　w",
    "a <|endoftext|> b", "in<|endoftext|>side word", "end  ", "it's we'll 12 345", "a\x1c b \x85c", "<|endoftext|> x", "The quick brown fox.\nJumps over  the lazy dog", "\x00 zero", "é́ ﬁ",
]


def rows():
    rng = random.Random(3)
    many = [" ".join(rng.choice(["the", "ing", "Straße", "x1", "hello,", "a.\nB"]) for _ in range(rng.randint(1, 60))) for _ in range(40)]
    return [(i * 7 % 97, t) for i, t in enumerate(TEXTS + many)] + [(500, None), (None, "no id"), (501, "the"), (501, "the")]


# records

def test_words_and_whole_texts_give_the_same_ids():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    texts = [x or "" for _, x in rows()]
    got = records.WordEncoder(BYTES, limit=10).encode([x.encode() for x in texts])
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def test_words_are_looked_up_once_however_often_they_stand():
    """A portion's words are looked up per distinct word; their occurrences are numbers that Arrow puts in order."""
    class Known(dict):
        looked = 0

        def __getitem__(self, key):
            Known.looked += 1
            return dict.__getitem__(self, key)

    encoder = records.WordEncoder(BYTES)
    encoder.known = Known()
    texts = ["one two " * 500 + "one", "", "two"]
    got = encoder.encode([x.encode() for x in texts])
    want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, f"<u{encoder.width}").tolist() for x in got] == [e.ids for e in want]
    assert Known.looked < 10


def test_records_round_trip(spark, docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BYTES)
    folder = new_path(spark, "records")
    got = records.token_records(docs(*rows()), BYTES, folder).orderBy("start").collect()
    order = sorted(rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in got] == [i for i, _ in order]
    start = 0
    by_id = {}
    for r, (i, text) in zip(got, order):
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        by_id[i] = ids
    # single records in any order, through the index
    for f in spark.read.parquet(f"{folder}/files").collect():
        file = records.RecordFile(f"{folder}/{f['file']}")
        assert len(file) == f["n_docs"]
        for k in reversed(range(len(file))):
            doc_id, ids = file[k]
            assert ids.tolist() == by_id[doc_id]


def test_records_of_an_empty_table(docs):
    assert records.token_records(docs(), BYTES).count() == 0


def test_damage_is_found():
    import io

    data = records.frame(b"payload")
    assert records.unframe(io.BytesIO(data), "x") == b"payload"
    assert struct.unpack_from("<Q", data)[0] == 7
    for i in range(len(data)):
        broken = data[:i] + bytes([data[i] ^ 1]) + data[i + 1:]
        with pytest.raises(ValueError):
            records.unframe(io.BytesIO(broken), "x")
    with pytest.raises(ValueError):
        records.unframe(io.BytesIO(data[:-1]), "x")


# merge-dropout

@pytest.fixture(scope="module")
def model():
    return MergeModel(PIECES)


def test_without_dropout_the_library_agrees(model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = [t or "" for _, t in rows()]
    got = DropoutEncoder(model, 0.0, 1).encode([0] * len(texts), [0] * len(texts), [t.encode() for t in texts])
    assert [np.frombuffer(g, "<u2").tolist() for g in got] == [sp.encode(t) for t in texts]


def test_rounds_equal_the_agenda(model):
    rng = random.Random(4)
    words = ["".join(rng.choice("aeinrstähou▁é\n日") for _ in range(rng.randint(1, 40))).encode() for _ in range(1500)]
    keys = np.array([rng.getrandbits(64) for _ in words], np.uint64)
    for dropout in (0.0, 0.2, 0.9, 1.0):
        together = DropoutEncoder(model, dropout, 9).segment(words, keys)
        assert together == DropoutEncoder(model, dropout, 9, longest=0).segment(words, keys)
        assert together == DropoutEncoder(model, dropout, 9).segment(words, keys, at_once=7)


def merged_plainly(sp, text, key, dropout):
    """Piece ids of one word by looking at all neighbours again after each merge, with the draws spelled out."""
    bits = (1 << 64) - 1

    def finish(x):
        x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & bits
        return x ^ x >> 29

    def left_out(a, b, c):
        span = finish(a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + c * 0x165667B19E3779F9 & bits)
        return (finish(key ^ span) >> 11) / 2 ** 53 < dropout

    parts, at = list(text), list(range(len(text) + 1))
    usable = lambda p: not (sp.is_unknown(sp.piece_to_id(p)) or sp.is_byte(sp.piece_to_id(p)) or sp.is_control(sp.piece_to_id(p)))
    while True:
        found = []
        for i in range(len(parts) - 1):
            both = parts[i] + parts[i + 1]
            if usable(both) and not left_out(at[i], at[i + 1], at[i + 2]):
                found.append((-sp.get_score(sp.piece_to_id(both)), i))
        if not found:
            break
        _, i = min(found)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del at[i + 1]
    ids = []
    for p in parts:
        ids += [sp.piece_to_id(p)] if usable(p) else [sp.piece_to_id(f"<0x{x:02X}>") for x in p.encode()]
    return ids


def test_draws_equal_a_plain_implementation(model):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rng = random.Random(6)
    words = ["international", "understanding", "größer", "日本語", "a", "", "über" * 20] + [
        "".join(rng.choice("aeinrsthou.é日") for _ in range(rng.randint(1, 25))) for _ in range(150)]
    keys = np.array([rng.getrandbits(64) for _ in words], np.uint64)
    for dropout in (0.0, 0.15, 0.5, 1.0):
        want = [merged_plainly(sp, "▁" + w, int(k), dropout) for w, k in zip(words, keys)]
        got = DropoutEncoder(model, dropout, 1).draw([w.encode() for w in words], keys)
        assert [np.frombuffer(g, "<u2").tolist() for g in got] == want


def test_dropout_leaves_out_about_its_share(model):
    symbols = [model.ids[c] for c in "▁international"]
    whole = agenda(model, symbols, 1, 0.0)
    assert len(agenda(model, symbols, 1, 1.0)) == len(symbols)
    ways = {tuple(agenda(model, symbols, key * 7919, 0.3)) for key in range(200)}
    assert tuple(whole) in ways and len(ways) > 10


def test_pieces_decode_to_the_text(docs, model):
    texts = rows() + [(600, "▁ literal ▁▁ mark"), (601, "▁")]
    encoded = encode_documents(docs(*texts), PIECES, dropout=0.3)
    back = decode_documents(encoded, PIECES).collect()
    assert sorted((repr(tuple(r)) for r in back)) == sorted(repr((i, t or "")) for i, t in texts)
    digests = encoded_digests(docs(*texts), PIECES, dropout=0.3).collect()
    assert all(r["lossless"] for r in digests) and len(digests) == len(texts)
    ids = {(r["doc_id"], r["n_pieces"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in encoded.collect()}
    assert {tuple(r)[:3] for r in digests} == ids
    assert encode_documents(docs(), PIECES).count() == 0


def test_segmentations_vary_by_seed_and_document(docs):
    table = docs(*[(i, "international understanding of representations") for i in range(60)])
    ways = lambda seed: [tuple(r["ids"]) for r in encode_documents(table, PIECES, 0.3, seed).orderBy("doc_id").collect()]
    assert ways(1) == ways(1) and ways(1) != ways(2) and len(set(ways(1))) > 8


def test_kept_words_change_no_draw(model):
    rng = random.Random(5)
    words = ["".join(rng.choice("aeinrstähou▁é\n日") for _ in range(rng.randint(1, 60))).encode() for _ in range(300)] * 4
    keys = np.array([rng.getrandbits(64) for _ in words], np.uint64)
    for dropout in (0.0, 0.1, 0.6, 1.0):
        encoder = DropoutEncoder(model, dropout, 9, limit=500)
        want = encoder.segment(words, keys)
        assert encoder.draw(words, keys) == want and encoder.draw(words[200:900], keys[200:900]) == want[200:900]


def test_every_occurrence_and_repetition_has_its_own_draw(spark, docs):
    text = " ".join(["international understanding"] * 40)
    table = docs(*[(i // 3, text) for i in range(60)])
    found = [tuple(r) for r in corpus_pipeline.encoded(spark, table, "").select("doc_id", "ids").collect()]
    assert len({(i, tuple(ids)) for i, ids in found}) == 60  # repetitions differ
    again = corpus_pipeline.encoded(spark, table.repartition(7), "").select("doc_id", "ids").collect()
    assert sorted(map(repr, found)) == sorted(repr(tuple(r)) for r in again)
    ways = DropoutEncoder(MergeModel(PIECES), 0.3, 1).draw([b"international"] * 400, np.arange(400, dtype=np.uint64) * np.uint64(7919))
    assert len(set(ways)) > 20
    one = encode_documents(docs((1, text)), PIECES, 0.3).first()["ids"]
    assert len({tuple(one[i:i + 2]) for i in range(0, len(one), 2)}) > 8  # within one document too


# pipeline

def pipeline_rows():
    rng = random.Random(11)
    parts = {"de": ["sch", "ung", "ein", "ich"], "en": ["the", "ing", "tion", "wh"]}
    word = lambda x: "".join(rng.choice(parts[x]) for _ in range(rng.randint(1, 4)))
    shared = "the thing which whitens nothing within the tiniest " + "whing " * 8
    out = []
    for i in range(120):
        x = rng.choice(list(parts))
        lines = [" ".join(word(x) for _ in range(rng.randint(4, 14))) for _ in range(rng.randint(1, 6))]
        if i % 6 == 0:
            lines.insert(0, shared)
        out.append((i, "\n".join(lines), x, f"s{i % 4}" if i % 5 else "big"))
    out += [(200 + i, out[i * 3][1] + (" extra" if i % 2 else ""), out[i * 3][2], "big") for i in range(20)]
    return out + [(300, None, "en", "s1"), (301, "123 456 !!", "en", "s1"), (302, "", None, None), (303, "漢字" * 60, "en", "s2")]


def test_each_stage_on_its_own_input(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language identification", "line dedup", "n-gram jaccard join", "mixing sources", "pieces"]
    given = pipeline_rows()
    table = docs(*given)
    columns, plain = table.columns, lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)
    stages = [f for _, f in corpus_pipeline.STAGES]

    known = stages[0](spark, table, "")
    assert known.columns == columns and plain(known) == sorted(((i, t) for i, t, _, _ in given if i < 300), key=repr)
    known = known.cache()

    lines = stages[1](spark, known, "")
    assert lines.columns == columns
    assert plain(lines) == sorted(((i, t) for i, t, _, _ in lines_plain(plain(known))), key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    lines = lines.cache()

    single = stages[2](spark, lines, "")
    keep = {a for a, _, c in jaccard_plain(plain(lines), 5, 80) if a == c}
    assert single.columns == columns and plain(single) == [r for r in plain(lines) if r[0] in keep]
    single = single.cache()

    mixed = stages[3](spark, single, "")
    assert mixed.columns == columns
    taken = {r["doc_id"]: r["taken"] for r in mix(single).collect() if r["taken"]}
    words = {}
    for i, t in plain(mixed):
        words[i] = words.get(i, 0) + len([w for w in re.split("[ \t\n\x0b\f\r]+", t) if w])
    assert words == taken

    pieces = stages[4](spark, mixed, "")
    back = decode_documents(pieces, PIECES)
    assert plain(back) == plain(mixed)


def test_stages_take_empty_tables(spark, docs):
    table = docs().where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, table, "").count() == 0
