import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import compare
from test_tokens import in_calls, texts
from tollbook.llm import queries, tree_bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def expected(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    return ids, LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.fixture(scope="module")
def codec():
    return tree_bpe.TreeBpe(PATH)


def test_equals_the_library(codec):
    rng = random.Random(4)
    lot = texts(11) + ["a" * k for k in range(300)] + ["ab" * k for k in range(0, 2000, 97)]
    lot += ["".join(chr(rng.randint(97, 122)) for _ in range(rng.randint(1, 900))) for _ in range(200)]
    lot += ["x<|startoftext|><|endoftext|>y<|endoftext|", "<|endoftext|>", "<|ENDOFTEXT|>", " \n "]
    found = in_calls(codec.encode, lot)
    assert found == [expected(t)[0] for t in lot]
    assert [codec.decode(np.array(x, np.int64)) for x in found] == [expected(t)[1] for t in lot]


def test_a_tree_of_its_own_equals_trees_together(codec):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcinghe") for _ in range(rng.randint(2, 256))) for _ in range(150)]
    symbols = [np.array([*(codec.vocabulary[c] for c in w[:-1]), codec.vocabulary[w[-1] + "</w>"]]) for w in words]
    together = tree_bpe.merged_together(codec.ranks, symbols, 256)
    alone = [tree_bpe.merged_alone(codec.ranks, s) for s in symbols]
    assert [x.tolist() for x in together] == [x.tolist() for x in alone]


def test_forgetting_words_changes_nothing():
    small = tree_bpe.TreeBpe(PATH)
    small.memory.half = 50
    lot = texts(12, 500)
    assert in_calls(small.encode, lot) == [expected(t)[0] for t in lot]


def test_any_table(spark, documents):
    very_long = "The quick brown fox " * 150_000
    one_word = "qwerty" * 20_000
    rows = documents((1, None), (None, ""), (2, "Hello it's"), (2, "Hello it's"), (None, " \n"), (3, very_long), (4, one_word))
    found = tree_bpe.digests(rows, PATH)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def row(doc_id, text):
        ids, decoded = expected(text)
        return doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded))

    wanted = [row(1, ""), row(None, ""), row(2, "Hello it's"), row(2, "Hello it's"), row(None, ""), row(3, very_long), row(4, one_word)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(wanted, key=str)
    texts_again = {r["doc_id"]: r["text"] for r in tree_bpe.encode_documents(documents((2, "Hello it's")), PATH).collect()}
    assert texts_again == {2: "hello</w> it</w> 's</w>"}
    assert tree_bpe.digests(documents(), PATH).count() == 0


def test_query_over_a_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    rows = compare.connect(folder).execute("select doc_id, coalesce(text, '') from documents").fetchall()
    wanted = []
    for doc_id, text in rows:
        ids, decoded = expected(text)
        wanted.append((doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded))))
    assert sorted(map(tuple, queries.QUERIES["op12_tree_bpe"](spark, folder).collect())) == sorted(wanted)
