import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cellsheaf.llm.op09_pack import pack_documents, patterns
from cellsheaf.llm.tokens import encoded

ODD = [
    None, "", " ", "a", "It's  we'll\n\n x", " lead", "trail ", "Ünïcödé ÀÉ ñ ½ 12²", "tab\tnl\r\n \n y", "İ Σίσυφος ΣΑΣ", "é 漢字 emoji 🙂🙂",
    "<|endoftext|> in text <|startoftext|>", "nbsp\xa0here\x85 \x1c sep", "don't DON'T 'Re", "a" * 3000, "x1y22z333 4.5-6", "﻿bom", "ﬁ ligature Å",
]


def test_ids_are_those_of_the_library():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = public_tokenizers.path(name)
        library = Tokenizer.from_file(path)
        library.encode_special_tokens = True
        texts = ODD + [" ".join(t or "" for t in ODD), "\n".join(t or "" for t in ODD)]
        for text, ids in zip(texts, encoded(path, texts, 1)):
            want = [*library.encode(text or "", add_special_tokens=False).ids, 1]
            assert np.frombuffer(ids, "<u4").tolist() == want, repr(text)


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=40))
@settings(max_examples=200, deadline=None)
def test_patterns_place_every_length_once(histogram):
    found = patterns(histogram, 64)
    placed = {}
    for form, n in found:
        assert sum(form) <= 64 and n > 0
        for length in form:
            placed[length] = placed.get(length, 0) + n
    assert placed == histogram
    tokens, full = sum(k * n for k, n in histogram.items()), sum(n for _, n in found)
    # No two packs are half empty, as the second would have gone into the first.
    assert full <= 2 * tokens / 64 + 1


def test_packed_documents(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ODD + ["w %d " % i * (i % 90) for i in range(150)] + ["long text " * 9000] + ["same size"] * 80
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("length", F.lit("clash")).repartition(4)
    for size in (2048, 32):
        rows = pack_documents(docs, size=size, with_ids=True).collect()
        whole = dict(zip(range(len(texts)), encoded(path, texts, 1)))
        by_doc, by_sequence = {}, {}
        for r in rows:
            by_doc.setdefault(r["doc_id"], []).append(r)
            by_sequence.setdefault(r["sequence_id"], []).append(r)
            assert r["ids_crc32"] == zlib.crc32(r["ids"]) and r["length"] * 4 == len(r["ids"])
        assert set(by_doc) == set(whole)
        for i, parts in by_doc.items():
            parts.sort(key=lambda r: r["start"])
            assert b"".join(r["ids"] for r in parts) == whole[i]
            assert [r["start"] for r in parts] == np.cumsum([0, *(r["length"] for r in parts)])[:-1].tolist()
            assert {r["doc_tokens"] for r in parts} == {len(whole[i]) // 4}
        for parts in by_sequence.values():
            parts.sort(key=lambda r: r["offset"])
            assert [r["offset"] for r in parts] == np.cumsum([0, *(r["length"] for r in parts)])[:-1].tolist()
            total = sum(r["length"] for r in parts)
            assert total <= size and {r["padded_length"] for r in parts} == {total if total & (total - 1) == 0 else size}
    assert pack_documents(docs.limit(0)).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "a b"), (None, None)], "doc_id long, text string")
    got = pack_documents(twice).collect()
    assert len(got) == 4 and {r["sequence_id"] for r in got} == {0}
