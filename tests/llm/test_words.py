import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

import llm.brute as brute
from tollbook.llm import words

TEXTS = st.lists(st.text(alphabet="ab \n\t\x0bé日", max_size=30), max_size=6)


@given(TEXTS)
def test_equal_words_have_equal_hashes(texts):
    found = words.hashed_words([t.encode() for t in texts])
    names = {}
    for text, hashes in zip(texts, found):
        expected = brute.WORD.findall(text)
        assert len(expected) == len(hashes)
        for word, value in zip(expected, hashes.tolist()):
            assert names.setdefault(word, value) == value
    assert len(set(names.values())) == len(names)


def test_long_texts_are_cut_between_words():
    text = " ".join(f"word{k}" for k in range(2000)).encode()
    parts = list(words.cut(text, 100))
    assert len(parts) > 10 and b"".join(parts) == text
    assert list(words.cut(b"x" * 1000, 10)) == [b"x" * 1000]
    whole = words.hashed_words([text])[0]
    assert (np.concatenate(words.hashed_words(parts)) == whole).all()


@given(st.dictionaries(st.integers(0, 10**12), st.integers(0, 10**6), max_size=300))
def test_int_table_is_a_dictionary(pairs):
    table = words.IntTable(4)
    items = list(pairs.items())
    for some in (items[:3], items[3:]):
        table.put(np.array([k for k, _ in some], np.int64), np.array([v for _, v in some], np.int64))
    keys = np.array(list(pairs) + [10**12 + 1], np.int64)
    assert table.get(keys).tolist() == [*pairs.values(), -1]


def test_batches_hold_about_a_size_and_null_is_empty():
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, None, 3, 4]), pa.array(["aaaa", None, "b", "cccc"])], names=["k", "t"]
    )
    keys = [k for ks, _ in words.read([batch], 5) for k in ks]
    texts = [t for _, ts in words.read([batch], 5) for t in ts]
    assert keys == [1, None, 3, 4] and texts == [b"aaaa", b"", b"b", b"cccc"]


def test_what_is_remembered_is_bounded():
    calls = []

    def encode(new):
        calls.append(len(new))
        return np.array([len(w) for w in new], np.int32), np.ones(len(new), np.int64)

    memory = words.Memory(encode, 20, spaced=False)
    for begin in range(0, 100, 5):
        ids, counts = memory.ids_of([" ".join("x" * k for k in range(begin + 1, begin + 6)).encode()])
        assert ids.tolist() == list(range(begin + 1, begin + 6)) and counts.tolist() == [5]
        assert len(memory.known) <= 15
    assert sum(calls) == 100
