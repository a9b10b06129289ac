import random
import zlib

import numpy as np
import pytest

from posegrid.llm import packing, pieces

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_word_ids_are_those_of_the_library():
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    random.seed(5)
    parts = [" ", " ", "\n", "\t", " ", "　", "\x1c", "\x85", "a", "b", "Ab", "é", "'s", "'ll", "1", "２", "²", "!",
             "#", "😀", "ſ", "​", "<|endoftext|>", "中", "\r", "word", "Thingly."]
    texts = ["".join(random.choice(parts) for _ in range(random.randint(0, 14))) for _ in range(5000)]
    for text, ids in zip(texts, packing.token_ids(texts, packing.default_ranks(), None)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_first_fit_decreasing_by_scanning():
    random.seed(2)
    for _ in range(100):
        lengths = [random.randint(1, 50) for _ in range(random.randint(0, 40))]
        room, want = [], {}
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
            b = next((b for b, r in enumerate(room) if r >= lengths[i]), len(room))
            if b == len(room):
                room.append(50)
            room[b] -= lengths[i]
            want[i] = b
        assert packing.first_fit_decreasing(lengths, 50) == [want[i] for i in range(len(lengths))]


def test_packing_is_whole_and_unpadded():
    random.seed(3)
    for _ in range(200):
        lengths = [random.choice([0, 1, 2, 5, 500, 2047, 2048, 2049, 5000, random.randint(1, 4000)])
                   for _ in range(random.randint(0, 60))]
        pieces_of = [[] for _ in lengths]
        for sequence in packing.pack(lengths):
            total = sum(n for _, _, n in sequence)
            assert 0 < total <= 2048 and total & (total - 1) == 0
            for doc, start, n in sequence:
                pieces_of[doc].append((start, n))
        for length, got in zip(lengths, pieces_of):
            at = 0
            for start, n in sorted(got):
                assert start == at and n > 0
                at += n
            assert at == length


def test_packed_documents(odd, nothing):
    got = packing.pack_documents(odd, group_rows=4).collect()
    texts = sorted(((r["doc_id"], r["text"]) for r in odd.collect()), key=str)
    want = sorted((i if i is not None else -1, zlib.crc32(x)) for (i, _), x in zip(
        texts, packing.token_ids([t for _, t in texts], packing.default_ranks())))
    # documents put together again; rows that share an id are told apart by their places
    sequences, docs = {}, {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append(r)
        docs.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
        assert len(r["ids"]) == 4 * r["length"]
    for rows in sequences.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and at & (at - 1) == 0
    single = [(k[0] if k[0] is not None else -1, zlib.crc32(b"".join(r["ids"] for r in sorted(rows, key=lambda r: r["start"]))))
              for k, rows in docs.items() if sum(r["length"] for r in rows) == k[1]]
    assert single and set(single) <= set(want)
    assert sum(r["length"] for r in got) == sum(len(x) // 4 for x in packing.token_ids([t for _, t in texts], packing.default_ranks()))
    assert packing.pack_documents(nothing).count() == 0


def test_pieces_round_trip(odd, nothing):
    back = pieces.decode(pieces.encode(odd))
    assert back.count() == odd.count()
    assert back.where("not (decoded <=> text)").count() == 0
    assert back.where("(ids is null) <> (text is null)").count() == 0
    assert pieces.decode(pieces.encode(nothing)).count() == 0


def test_segmentations_are_best():
    tool = pieces.Pieces(pieces.default_model(), most=50)
    random.seed(1)
    words = sorted({" " * random.randint(1, 3) + "".join(random.choice("abcdethinsr▁é中\n") for _ in range(random.randint(0, 12)))
                    for _ in range(1500)})

    def best(word):
        at = [0.0]
        for j in range(1, len(word) + 1):
            ways = [at[i] + tool.score[word[i:j]] for i in range(j) if word[i:j] in tool.score]
            at.append(max(ways) if ways else at[j - 1] + tool.fallback)
        return at[-1]

    for word, ids in tool.forward(words):
        numbers = np.frombuffer(ids, np.int32).tolist()
        total = sum(tool.score[tool.text[i].decode()] for i in numbers if i not in set(tool.byte))
        total += tool.fallback * sum(c not in tool.score for c in word)
        assert abs(total - best(word)) < 1e-6
        assert b"".join(tool.text[i] for i in numbers).decode() == word


def test_pieces_don_t_depend_on_the_word_table():
    texts = [" ".join(random.Random(i).choices(["alpha", "beta", "gamma", "x▁y", "中文"], k=30)) for i in range(40)]
    small, large = pieces.Pieces(pieces.default_model(), most=2), pieces.Pieces(pieces.default_model())
    assert [small.encode([t])[0] for t in texts] == large.encode(texts)
    assert len(small.words) <= 2


def test_documents_have_the_ids_of_the_library_by_default(spark):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    random.seed(6)
    parts = [" ", "\n", "a", "word", "é", "'s", "1", "!", "<|endoftext|>", "<|endoftext|", "|>", "<", "\t", "　"]
    texts = ["a <|endoftext|> b"] + ["".join(random.choices(parts, k=random.randint(0, 12))) for _ in range(3000)]
    for text, ids in zip(texts, packing.token_ids(texts, packing.default_ranks())):
        want = library.encode(text, add_special_tokens=False).ids + [packing.END_ID]
        assert np.frombuffer(ids, "<u4").tolist() == want, text
    rows = packing.pack_documents(spark.createDataFrame([(1, texts[0])], "doc_id long, text string")).orderBy("start").collect()
    assert np.frombuffer(b"".join(r["ids"] for r in rows), "<u4").tolist() == [64, 220, 50256, 275, packing.END_ID]


def test_one_word_of_a_million_characters():
    import tracemalloc

    tool = pieces.Pieces(pieces.default_model())
    random.seed(9)
    word = "".join(random.choices("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/é", k=1_000_000))
    tracemalloc.start()
    ids = np.frombuffer(tool.encode([word])[0], np.int32)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500_000_000
    assert tool.decode(ids.tolist()) == word
    # the best path to a place within a long word is the same as in the word alone
    short = np.frombuffer(tool.encode([word[:5000]])[0], np.int32)
    assert (ids[:len(short) - 20] == short[:-20]).all()


def test_the_word_table_is_small():
    """A worker keeps it, so it counts in all later stages."""
    import tracemalloc

    words = packing.WordIds(packing.default_ranks())
    texts = [" ".join(f"w{i:x}q{j}" for i in range(1000)) for j in range(250)]
    first = [words.of(t) for t in texts[:2]]
    tracemalloc.start()
    for t in texts:
        words.of(t)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 32_000_000
    assert [words.of(t) for t in texts[:2]] == first == [words.whole(t) for t in texts[:2]]
    assert words.of(texts[-1]) == words.whole(texts[-1])
