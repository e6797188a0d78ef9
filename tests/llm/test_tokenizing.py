import random

import pytest

from podium.llm.tokenizing import TOKENIZERS, BacktrackingEncoder, encode_corpus

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def pair():
    t = tokenizers.Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
    t.encode_special_tokens = True
    return BacktrackingEncoder(f"{TOKENIZERS}/byte_bpe_50k.tiktoken"), lambda s: t.encode(s, add_special_tokens=False).ids


def test_equals_the_merges(pair):
    ours, theirs = pair
    r = random.Random(9)
    words = list(ours.strings.values())
    letters = [chr(i) for i in range(32, 127)] + list("éßяж中あ한😀‍\n\t  ")
    for i in range(1500):
        s = [
            lambda: "".join(r.choice(letters) for _ in range(r.randint(1, 60))), lambda: "".join(r.choice("abeinorst ") for _ in range(r.randint(1, 60))),
            lambda: "".join(r.choice(words) for _ in range(r.randint(1, 12))).encode("latin-1").decode("utf-8", "ignore"), lambda: r.choice("a=-_ \n!") * r.randint(1, 300) + "<|endoftext|>",
        ][i % 4]()
        assert ours(s) == theirs(s), s


def test_long_pieces_are_linear(pair):
    ours, theirs = pair
    assert ours("x" * 50_000) == theirs("x" * 50_000)
    assert ours("ab" * 100_000)
    long = "never " + "seen" * 40 + " before " + "seen" * 40
    assert ours(long) == theirs(long) and all(len(p) <= 64 for p in ours.pieces)


def test_frame(spark, pair):
    df = spark.createDataFrame([(1, "Hello world", [1]), (2, None, None), (3, "", None), (1, "Hello world", [2])], "doc_id bigint, text string, ids array<int>")
    got = sorted((r.doc_id, list(r.ids)) for r in encode_corpus(df).collect())
    assert got == sorted([(1, pair[1]("Hello world"))] * 2 + [(2, []), (3, [])])
    assert encode_corpus(df.limit(0)).count() == 0


def test_rest_of_the_vocabulary_files(spark):
    ours = BacktrackingEncoder(f"{TOKENIZERS}/byte_bpe_multi_50k.tiktoken")
    assert "".join(ours.strings[i] for i in ours("Grüße, мир, 世界")).encode("latin-1").decode() == "Grüße, мир, 世界"
