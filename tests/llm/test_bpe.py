import cProfile
import gc
import hashlib
import random
import re
from types import SimpleNamespace

import pyarrow as pa
import pytest

from txnwatch.llm import bpe as B
from txnwatch.llm.catalog import vocabulary_path
from txnwatch.llm.common import give_back

PARTS = ["a", "the", " ", "  ", "\n", "\t", "'s", "é", "1", "!", "<|endoftext|>", "日本", "\x1c", "\r", "_", "😀", "\x00", "'", "ll", "́", "\xa0", "²"]


@pytest.fixture(scope="module", autouse=True)
def memory_given_back():
    """Steps run in this process would leave free memory, and a later test measures that."""
    yield
    gc.collect()
    give_back()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_path())


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (len(ids), sha(",".join(map(str, ids))), sha(back), ids, back)


def test_against_the_library(spark, docs, library, odd_rows):
    random.seed(11)
    texts = ["".join(random.choice(PARTS) for _ in range(random.randrange(60))) for _ in range(1500)]
    rows = [(100 + i, t) for i, t in enumerate(texts)] + [r for r in odd_rows if r[0] != 5]
    got = B.encode_any(docs(rows), vocabulary_path(), full=True, block_bytes=3000, buckets=2, bucket_words=400).collect()
    assert len(got) == len(rows)
    found = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], list(r["ids"]), r["decoded"]) for r in got}
    for doc_id, text, *_ in rows:
        assert found[doc_id] == expected(library, text or ""), text


def test_repeated_rows_and_empty_table(spark, docs):
    rows = B.encode_any(docs([(5, "one two")] * 3), vocabulary_path()).collect()
    assert len(rows) == 3 and len({tuple(r) for r in rows}) == 1
    assert B.encode_any(docs([]), vocabulary_path()).count() == 0
    assert [r["n_tokens"] for r in B.encode_any(docs([(1, None), (2, "")]), vocabulary_path()).collect()] == [0, 0]


def test_cuts_give_the_text_back():
    random.seed(12)
    for _ in range(3000):
        text = "".join(random.choice("ab  \n\t\xa0") for _ in range(random.randrange(1, 20)))
        assert " ".join(B.words_of(text)) == text


def test_every_byte_has_a_character(library):
    assert sorted(B.byte_characters().values()) == list(range(256))
    assert set(B.byte_characters()) <= set("".join(library.get_vocab()))


def test_other_tokenizers_are_refused(tmp_path):
    import json

    spec = json.load(open(vocabulary_path(), encoding="utf-8"))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        B.load(str(path))


def test_words_that_are_not_held_and_a_long_text(spark, docs, library):
    random.seed(13)
    long = ["".join(random.choice("abcdé") for _ in range(n)) for n in (400, 600, 5000)]
    rows = [(i, " ".join(random.choice([*long, "short", "words", "between"]) for _ in range(12))) for i in range(40)]
    rows.append((99, " ".join(f"w{random.randrange(3000)}" for _ in range(150_000))))
    found = {}
    for buckets in (1, 5):
        got = B.encode_any(docs(rows), vocabulary_path(), block_bytes=20_000, buckets=buckets).collect()
        found[buckets] = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got}
    assert found[1] == found[5] == {i: expected(library, t)[:3] for i, t in rows}


def plain_words(text):
    """Cut part by part: at special tokens, and before a space after a character that isn't white space."""
    words = []
    for part in re.split(r"(<\|endoftext\|>|<s s>)", text):
        start = 0
        for i in range(1, len(part)):
            if part[i] == " " and not part[i - 1].isspace() and part not in ("<|endoftext|>", "<s s>"):
                words.append(part[start:i])
                start = i
        words += [part[start:]] if part else []
    return [w.encode() for w in words]


def test_cuts_of_many_texts_against_a_plain_cut():
    random.seed(14)
    white = [c for c in map(chr, range(0x110000)) if c.isspace()]
    parts = [*PARTS, *white, "<s s>", "<|endof", "text|>", "<s", "à", "‐", " ", "　", "Ġ"]
    for _ in range(300):
        texts = ["".join(random.choices(parts, k=random.randrange(25))) for _ in range(random.randrange(9))]
        rows = pa.array([t.encode() for t in ["cut off", *texts]], pa.large_binary()).slice(1)
        words, counts = B.cut(rows, ["<|endoftext|>", "<s s>"])
        expected = [plain_words(t) for t in texts]
        assert words.to_pylist() == [w for of in expected for w in of]
        assert counts.tolist() == [len(of) for of in expected]


def test_cutting_and_joining_make_no_call_for_each_word(monkeypatch, library):
    """the interpreter's work per word was most of the operator's CPU time."""
    random.seed(15)
    words = [f"word{i}" for i in range(20_000)]
    text = " ".join([*words, *random.choices(words, k=80_000)])
    monkeypatch.setattr(B, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    rows = pa.table({"doc_id": [7], "text": [text]}).to_batches()
    spec, special = B.load(vocabulary_path())

    def counted(work):
        profile = cProfile.Profile()
        found = profile.runcall(work)
        return found, sum(entry.callcount for entry in profile.getstats())

    lists, calls = counted(lambda: list(B._lists(special, 1, 1 << 20)(rows)))
    assert calls < 5000
    blocks, calls = counted(lambda: list(B._positions(special, 1, 1 << 20)(rows)))
    assert calls < 5000
    encoded = list(B._encoder(spec)((pa.scalar(0),), iter(lists)))
    join = B._assembler(False, library.get_vocab_size())
    found, calls = counted(lambda: join(None, pa.Table.from_batches(blocks), pa.Table.from_batches(encoded)))
    assert calls < 5000
    assert [tuple(r.values()) for r in found.to_pylist()] == [(7, *expected(library, text)[:3])]
