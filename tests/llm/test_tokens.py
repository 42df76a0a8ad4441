import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from demandspark.llm import blocks, packing
from demandspark.llm.common import new_path
from demandspark.llm.tokenization import TEXTS_AT_ONCE, PieceTokenizer, SharedTokenizer
from tests.llm import samples

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
ODD = [" ", "  ", "\n", "\n\n", "\t", "a", "B", "'s", "'", "1", "23", "e\u0301", "é", "\x1c", "\x85", ".", "!!", ",", "<|endoftext|>",
       "日本", "ß", "İ", "Σ", "\r\n", "\u200b", "x" * 60, "\x00", "\u0301", "ﬁ", "__", "½", "\u3000"]


def plain(name, plain_specials=None):
    """The library untouched, unless told to take special strings for text."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    if plain_specials is not None:
        tokenizer.encode_special_tokens = plain_specials
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
def test_pieces_give_the_ids_of_whole_texts(name):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(4000)] + [samples.prose(i, 200) for i in range(20)]
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        cached = PieceTokenizer(file.read())
    whole = plain(name)
    for _ in range(2):  # cold and from the cache
        assert [ids.tolist() for ids in cached.encode(texts)] == [whole(t) for t in texts]


@pytest.mark.parametrize("name", FILES)
def test_special_strings_follow_the_library(name):
    texts = ["hello <|endoftext|> there", "<|endoftext|>", "a<|ENDOFTEXT|>b", "x <|startoftext|><|endoftext|>", "<|endoftext", "no special"]
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        definition = file.read()
    for flag, whole in ((False, plain(name)), (True, plain(name, True))):
        cached = PieceTokenizer(definition, plain_specials=flag)
        assert [ids.tolist() for ids in cached.encode(texts)] == [whole(t) for t in texts]
    assert plain(name)(texts[0]) != plain(name, True)(texts[0])


@pytest.mark.parametrize("name", FILES)
def test_words_with_marks_match_whole_texts(name):
    rng = random.Random(2)
    marks = ["###", "!!", ".%%%", "&&&", "...", "'s", "n't", "'", ")", "_", "`", "-x", "$$$|", "?!" * 8, "…", "!'s"]
    words = ["Word", "word", "Émentment", "straße", "İx", "é", "Zu", "ñandú", "can", "A"]
    texts = [" ".join(rng.choice(words) + rng.choice(marks) for _ in range(rng.randint(1, 8))) for _ in range(3000)]
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        cached = PieceTokenizer(file.read())
    whole = plain(name)
    assert [ids.tolist() for ids in cached.encode(texts)] == [whole(t) for t in texts]


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr("demandspark.llm.tokenization.CACHE_PIECES", 50)
    with open(public_tokenizers.path(FILES[0]), encoding="utf-8") as file:
        cached = PieceTokenizer(file.read())
    whole = plain(FILES[0])
    for i in range(30):
        text = samples.prose(i, 60)
        assert cached.encode([text])[0].tolist() == whole(text)
        assert len(cached.young) + len(cached.old) < 300


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_best_fit_respects_every_capacity(score):
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 2048, 600)
    capacity = packing.Capacity(2048, documents=3, attention=2048**2, score=score)
    bins, offsets = packing.best_fit(lengths, capacity)
    for b in np.unique(bins):
        mine = np.flatnonzero(bins == b)
        mine = mine[np.argsort(offsets[mine])]
        assert offsets[mine].tolist() == [0, *np.cumsum(lengths[mine])[:-1].tolist()]
        assert lengths[mine].sum() <= 2048 and len(mine) <= 3 and (lengths[mine] ** 2).sum() <= 2048**2
    free, _ = packing.best_fit(lengths, packing.Capacity(2048, score=score))
    assert free.max() <= 1.05 * lengths.sum() / 2048 and free.max() <= bins.max()


def test_best_fit_of_nothing_and_of_impossible_capacities():
    assert len(packing.best_fit(np.zeros(0, np.int64), packing.Capacity())[0]) == 0
    with pytest.raises(ValueError):
        packing.Capacity(tokens=0)
    with pytest.raises(ValueError):
        packing.Capacity(tokens=100, attention=99)


def test_pieces_and_places(spark):
    tokenizer = SharedTokenizer(spark, public_tokenizers.path(FILES[0]))
    whole, size = plain(FILES[0]), 256
    rows = samples.awkward()
    got = packing.pack_documents(samples.documents(spark, clashing=True), tokenizer, packing.Capacity(tokens=size)).collect()
    want = []
    for row in rows:
        ids = np.array([*whole(row[1] or ""), 0], "<u4")
        head = len(ids) % size or size
        edges = [0, *range(head, len(ids) + 1, size)]
        for number, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
            want.append((row[0], number, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert len(sequences) <= sum(w[3] for w in want) / size * 1.1 + 1


def test_lots_pack_nearly_as_well_as_one(spark):
    rng = random.Random(4)
    rows = [(i, 0, 0, rng.randint(1, 2048), 7 * i) for i in range(3000)]
    cut = spark.createDataFrame(rows, packing.PIECE_COLUMNS)
    used = packing.pack(cut, packing.Capacity(), group_pieces=500).select("sequence_id").distinct().count()
    assert used <= 1.03 * sum(r[3] for r in rows) / 2048


@pytest.mark.parametrize(
    "ids",
    [[], [5], [2**32 - 1, 0, 7], list(range(5000)), [9] * 3000, [2**31 if i % 20 == 0 else i % 30 for i in range(5000)]],
)
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    data = blocks.encode(ids)
    assert (blocks.decode(data) == ids).all()
    for begin, end in ((0, 1), (1000, 2500), (1023, 1025), (len(ids) - 1, len(ids) + 5)):
        assert (blocks.decode(data, max(begin, 0), end) == ids[max(begin, 0) : end]).all()
    rng = np.random.default_rng(3)
    noise = rng.integers(0, 2**32, 3000, dtype=np.uint32)
    assert (blocks.decode(blocks.encode(noise)) == noise).all()


def test_small_ranges_and_outliers_take_little_room():
    values = np.random.default_rng(0).integers(1000, 1016, 10240).astype(np.uint32)
    values[::100] = 2**31
    assert len(blocks.encode(values)) < len(values) * 0.5 + 103 * 6 + 400
    with pytest.raises(ValueError):
        blocks.decode(b"XXXX" + blocks.encode(values)[4:])


def test_written_tokens_read_back(spark, monkeypatch):
    monkeypatch.setattr(blocks, "SEGMENT_IDS", 500)
    tokenizer, whole = SharedTokenizer(spark, public_tokenizers.path(FILES[1])), plain(FILES[1])
    path = new_path(spark, "tokens")
    rows = samples.awkward() + [(1000 + i, samples.prose(i, 50), "en", "s", 1) for i in range(60)]
    blocks.write_tokens(samples.documents(spark, rows, clashing=True).repartition(5), tokenizer, path)
    got = sorted(blocks.read_tokens(spark, path).collect(), key=lambda r: r.start)
    assert spark.read.parquet(path).count() > 10
    place = 0
    for r in got:
        assert r.start == place
        place += r.n_tokens
    assert [r.doc_id for r in got if r.doc_id is not None] == sorted(r[0] for r in rows if r[0] is not None)
    assert [r.doc_id for r in got[:2]] == [None, None]
    want = []
    for row in rows:
        ids = np.array([*whole(row[1] or ""), 1], "<u4")
        want.append((row[0], len(ids), zlib.crc32(ids.tobytes())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)


def test_empty_tables(spark):
    tokenizer = SharedTokenizer(spark, public_tokenizers.path(FILES[0]))
    assert packing.pack_documents(samples.documents(spark, []), tokenizer).count() == 0
    assert blocks.round_trip(samples.documents(spark, []), tokenizer).count() == 0


def test_texts_of_a_batch_are_encoded_a_few_at_a_time():
    """However long a batch, the writer turns few of its texts into strings and ids at once."""
    taken = []

    class Coder:
        def encode(self, texts):
            taken.append(len(texts))
            return [np.array([len(t)], np.uint16) for t in texts]

    batch = pa.RecordBatch.from_pydict({"id": [None, *range(1, 1001)], "body": ["x" * (n % 7) for n in range(1001)]})
    found = []
    for owner, ids in blocks.encoded(iter([batch, batch.slice(0, 0)]), Coder()):
        found.append((owner, ids.tolist()))
        assert sum(taken) - len(found) < TEXTS_AT_ONCE
    assert found == [(n or None, [n % 7]) for n in range(1001)]
    assert max(taken) <= TEXTS_AT_ONCE


def test_blocks_are_read_in_place():
    ids = np.arange(5000, dtype=np.uint32) % 777
    data = pa.array([blocks.encode(ids)])[0].as_buffer()
    assert blocks.decode(data).tolist() == ids.tolist()
    assert blocks.decode(data, 1500, 1600).tolist() == ids[1500:1600].tolist()
