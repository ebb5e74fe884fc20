"""Operator 11: token counts against the library's encoding of whole texts."""

import json

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paramo.llm import tokencount as T
from tests.llm.helpers import MEDIUM, documents, empty, messy

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
COUNT = T.Counter(PATH, T.proven(PATH))


def plain(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_every_document(spark):
    docs = documents(spark, MEDIUM)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = T.count_tokens(docs, PATH).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]]
        n = plain(text)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((text or "").encode()), n, n > 1024)


def test_messy_rows_and_empty_table(spark):
    docs = messy(spark)
    want = sorted(((r["doc_id"], len((r["text"] or "").encode()), plain(r["text"])) for r in docs.collect()), key=str)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in T.count_tokens(docs, PATH).collect()), key=str)
    assert got == want
    assert T.count_tokens(empty(spark), PATH).collect() == []


def test_proven_strings_are_whole_tokens_and_most_of_the_vocabulary():
    whole = T.proven(PATH)
    assert len(whole) > 49_000 and "<|endoftext|>" not in whole
    assert all(len(e.ids) == 1 for e in LIBRARY.encode_batch(whole, add_special_tokens=False))


def test_whole_tokens_are_never_merged(monkeypatch):
    count = T.Counter(PATH, T.proven(PATH))
    merged = []
    merge = count.merge
    monkeypatch.setattr(count, "merge", lambda x: merged.append(x) or merge(x))
    assert count("The cat sat on the mat") == plain("The cat sat on the mat") and merged == []
    assert count("The cat zqxj") == plain("The cat zqxj") and len(merged) == 1


@pytest.mark.parametrize("text", [
    "", " ", "  a", "a  \n\n b\t", "it's we'll 'S ''s", "<|endoftext|>", "a <|endoftext|><|endoftext|> b", "<|endoftext|", "x" * 50_000, "ab1" * 20_000, " \n" * 20_000,
    "ÀÉ ñandú Ωμέγα 東京タワー हिन्दी العربية", "  　x", "\x1c\x1d\x85 a", "١٢٣ ½ ²", "\U0001f600\U0001f468‍\U0001f469", "a࢏b \U00010940 Ᲊz", "﻿​­",
])
def test_odd_texts(text):
    assert COUNT(text) == plain(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.sampled_from([" ", "  ", "\n", "'s", "'LL", "<|endoftext|>", "12", "the", " The"])), max_size=12).map("".join))
def test_any_text(text):
    assert COUNT(text) == plain(text)


def test_every_character_is_parted_as_the_library_does():
    """All code points, in the contexts on which the classes of the pattern show."""
    unassigned = T.unassigned()
    for at in range(0, 0x110000, 0x400):
        text = "\n".join(f"a{c}1{c}! {c}" for c in map(chr, range(at, at + 0x400)) if not 0xD800 <= ord(c) < 0xE000)
        if COUNT.odd(text):
            text = unassigned.sub("", text)
        assert [text[a:b] for _, (a, b) in COUNT.part(text)] == [m.group() for m in COUNT.parts(text)]
        assert at or list(COUNT.pieces(text[:600])) == [m.group() for m in COUNT.parts(text[:600])]
        assert all(COUNT.merged(c) == sum(len(COUNT.merge(x)) for x, _ in COUNT.part(c)) for c in text[:100])


def test_what_is_remembered_is_bounded(monkeypatch):
    monkeypatch.setattr(T, "REMEMBER", 3)
    count = T.Counter(PATH, T.proven(PATH))
    text = " ".join(f"zq{chr(97 + i)}xv" for i in range(20))
    assert count(text) == plain(text) and max(map(len, (count.rest, count.after, count.first))) <= 3


def test_long_texts_are_cut_where_pre_tokens_begin(monkeypatch):
    monkeypatch.setattr(T, "SLICE", 7)
    for text in ("some plain words and more", "two  spaces   and\n\n lines \t x", "nospaceatallbutverylongword" * 3, " a b  c d e f g", "é à ü " * 9, "end "):
        assert COUNT(text) == plain(text)


def test_other_kinds_of_tokenizer_are_refused(tmp_path):
    with pytest.raises(ValueError):
        T.proven(public_tokenizers.path("word_bpe_49k.json"))
    told = json.load(open(PATH, encoding="utf-8"))
    told["pre_tokenizer"]["add_prefix_space"] = True
    (tmp_path / "t.json").write_text(json.dumps(told))
    with pytest.raises(ValueError):
        T.proven(str(tmp_path / "t.json"))
