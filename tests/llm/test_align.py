import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from claimbrook.llm import align
from claimbrook.llm.tokens import byte_level, pieces, tokenizer_path

public = pytest.importorskip("public_tokenizers")
A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


def brute(texts):
    """Counts and digests of texts, by plain loops and the tokenizer libraries themselves."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(tokenizer_path(A))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
    bytes_a, bytes_b = byte_level(tokenizer_path(A)).bytes, pieces(tokenizer_path(B)).bytes
    docs = []
    for text in texts:
        raw = (" " + (text or "")).encode()
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if not text or b"".join(bytes_a[i] for i in a) != raw or b"".join(bytes_b[i] for i in b) != raw:
            docs.append([])
            continue
        ends = []
        for ids, table in ((a, bytes_a), (b, bytes_b)):
            at, out = 0, []
            for i in ids:
                at += len(table[i])
                out.append((at, i))
            ends.append(out)
        stops = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        low, groups = 0, []
        for stop in stops:
            groups.append(tuple([i for e, i in side if low < e <= stop] for side in ends))
            low = stop
        docs.append(groups)
    links = [[(x, y) for ga, gb in groups for x in ga for y in gb] for groups in docs]
    count = {}
    for found in links:
        for pair in set(found):
            count[pair] = count.get(pair, 0) + 1
    high = {}
    for (x, _), n in count.items():
        high[x] = max(high.get(x, 0), n)
    out = []
    for groups, found in zip(docs, links):
        spelled = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in groups)
        out.append(
            (
                sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(found),
                sum(count[p] == high[p[0]] for p in found), sum(count[p] for p in found),
                hashlib.sha256(spelled.encode()).hexdigest() if groups else "",
            )
        )
    return out


TEXTS = [
    None, "", " ", "  two  spaces ", "plain words and plain words", "tab\tand\nline\r\n", "naïve café — 中文字符 和 日本語", "👩‍👩‍👧 emoji 😀😀",
    "<|endoftext|> <s> </s> <0x41>", "▁literal ▁mark", "ﬁ ligature Å", "a" * 300, "1234567890" * 20, "don't we'll it's", "plain words",
    "x" + " " * 600 + "y", "trailing space ", " leading", "plain words and plain words", "!!!???...,,,", "\x00\x01 control \x7f",
]


def run(spark, texts, **more):
    rows = [(i, t, "n") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string").repartition(3)
    found = {r.doc_id: tuple(r)[1:] for r in align.align(df, **more).collect()}
    return [found[i] for i in range(len(texts))]


def test_beside_brute_force(spark):
    assert run(spark, TEXTS) == brute(TEXTS)


def test_long_documents_are_composed(spark, monkeypatch):
    monkeypatch.setattr(align, "FAN", 2)
    rng = np.random.default_rng(4)
    words = ["the", "naïve", "中文", "x1", "ending.", "\n", "  wide", "don't", "<s>"]
    texts = [" ".join(rng.choice(words, n)) for n in (5, 400, 1500)] + ["unbroken" * 500, None]
    whole = align.aligned
    monkeypatch.setattr(align, "aligned", lambda *a: whole(*a, size=100))
    assert run(spark, texts) == brute(texts)


def test_repeated_rows_null_keys_and_none(spark):
    df = spark.createDataFrame([(None, "plain words", 1), (7, "plain words", 1), (7, "plain words", 1)], "doc_id long, text string, pairs int")
    got = sorted((tuple(r) for r in align.align(df).collect()), key=repr)
    want = brute(["plain words"] * 3)[0]
    assert [g[1:] for g in got] == [want] * 3 and {g[0] for g in got} == {None, 7}
    assert align.align(df.limit(0)).collect() == []


def streams(texts):
    aligner = align.Aligner(tokenizer_path(A), tokenizer_path(B))
    a, b = aligner.streams([" " + texts])[0]
    return a, np.cumsum(aligner.length_a[a]), b, np.cumsum(aligner.length_b[b])


def same(x, y):
    plain = lambda f: [getattr(f, n).tolist() if hasattr(getattr(f, n), "tolist") else getattr(f, n) for n in align.FIELDS]
    return plain(x) == plain(y)


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="ab é中😀\n.the ing'", min_size=1, max_size=60), st.data())
def test_composition_is_associative_over_any_byte_ranges(text, data):
    a, a_ends, b, b_ends = streams(text)
    n = int(a_ends[-1])
    cuts = sorted(data.draw(st.lists(st.integers(0, n), min_size=2, max_size=6)))
    parts = []
    for low, high in zip([0, *cuts], [*cuts, n]):
        ka, kb = (a_ends > low) & (a_ends <= high), (b_ends > low) & (b_ends <= high)
        parts.append(align.fragment(a[ka], a_ends[ka], b[kb], b_ends[kb]))
    want = align.fragment(a, a_ends, b, b_ends)
    left = parts[0]
    for p in parts[1:]:
        left = align.compose(left, p)
    right = parts[-1]
    for p in parts[-2::-1]:
        right = align.compose(p, right)
    at = data.draw(st.integers(1, len(parts) - 1))
    halves = align.compose(align.gathered(parts[:at]), align.gathered(parts[at:]))
    assert same(left, want) and same(right, want) and same(halves, want) and same(align.compose(align.Fragment(), want), want)


def test_wide_groups_are_counted_by_distinct_ids(monkeypatch):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 9, 50), rng.integers(0, 7, 40)
    ga, gb = np.sort(rng.integers(0, 4, 50)), np.sort(rng.integers(0, 4, 40))
    owner = np.array([0, 0, 1, 1])
    narrow = align.linked(a, ga, b, gb, owner)
    monkeypatch.setattr(align, "WIDE", 0)
    for x, y in zip(narrow, align.linked(a, ga, b, gb, owner)):
        assert x.tolist() == y.tolist()


def test_chunks_join_to_the_text():
    text = "ab cd  ef\tgh ij" * 50
    parts = align.chunks(text, 20)
    assert "".join(parts) == " " + text and len(parts) > 5 and all(p[0] == " " and p[1] != " " for p in parts[1:])


def test_byte_level_ids_are_the_librarys():
    own = byte_level(tokenizer_path(A))
    assert own.fast is not None
    rng = np.random.default_rng(6)
    alphabet = ["a", "the", "ing", " ", "  ", "\n", "'s", "é", "中", "😀", "12", ".", " ", "<|endoftext|>", " ", "_", "A"]
    for _ in range(500):
        text = "".join(rng.choice(alphabet, rng.integers(1, 40)))
        assert own.plain(text) == own.literal.encode(text, add_special_tokens=False).ids
        assert own.ids(text) == own.tokenizer.encode(text, add_special_tokens=False).ids
    assert own.plain(" " * 5000 + "a") == own.literal.encode(" " * 5000 + "a", add_special_tokens=False).ids
