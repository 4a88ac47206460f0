import base64
import hashlib
import random

import public_tokenizers
import tiktoken

from tests.llm.support import awkward_rows, documents, same_with_clashes
from tidewell.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_perfect_hash_is_minimal_and_exact():
    keys = [f"k{i}".encode() for i in range(3000)]
    index = bpe.PerfectHash(keys)
    assert sorted(index.slots.tolist()) == list(range(3000))
    assert index.find(keys) == list(range(3000))
    assert index.find([b"k3000", b"", b"other"]) == [-1, -1, -1]
    assert bpe.PerfectHash([]).find([b"a"]) == [-1]


def test_ids_match_the_public_library():
    tool, known = bpe.codec(PATH, public_tokenizers.PATTERN), reference()
    rng = random.Random(3)
    letters = " \n\tab'sé1! 　\x85\x1c漢\U0001f600"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 16))) for _ in range(4000)]
    texts += [t for _, t, *_ in awkward_rows() if t] + ["ab" * 20_000, "!" * 9_000, "x" * 5_000 + " y", "<|endoftext|>"]
    for text in texts:
        ids = tool.encode(text)
        assert ids.tolist() == known.encode_ordinary(text), text[:50]
        assert tool.decode(ids) == text.encode()


def test_words_in_use_are_merged_once(monkeypatch):
    """Words that come up in every text stay known while ever new ones pass through a small memo."""
    merged, plain, known = [], bpe.merge_bytes, reference()

    def counted(piece, *rest):
        merged.append(piece)
        return plain(piece, *rest)

    monkeypatch.setattr(bpe, "merge_bytes", counted)
    monkeypatch.setattr(bpe, "MEMO_ENTRIES", 40)
    tool = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    rng = random.Random(5)
    for _ in range(60):
        new = " ".join("".join(rng.choices("qxzjkv", k=9)) for _ in range(15))
        text = f"first qzxvkqj {new}, zzkqxvv. xvqqzkj"
        assert tool.encode(text).tolist() == known.encode_ordinary(text)
    often = [b" qzxvkqj", b" zzkqxvv", b" xvqqzkj"]
    assert [merged.count(w) for w in often] == [1, 1, 1]
    assert len(tool._words.new) <= 40 and len(tool._memo.new) <= 40


def test_query_rows(spark):
    rows = same_with_clashes(spark, lambda d: bpe.round_trip(d, PATH, public_tokenizers.PATTERN))
    known = reference()
    want = []
    for doc_id, text, *_ in awkward_rows():
        ids = known.encode_ordinary(text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        want.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert rows == sorted(want, key=repr)


def test_encode_decode_columns(spark):
    docs = documents(spark)
    both = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH, public_tokenizers.PATTERN)
    assert both.columns == [*docs.columns, "ids", "decoded"]
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in both.collect())
    checked = bpe.checked_ids(docs, PATH, public_tokenizers.PATTERN).collect()
    assert len(checked) == docs.count() and all(r.round_trip and len(r.ids) == r.n_tokens for r in checked)
