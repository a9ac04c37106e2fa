import os
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tabwright.llm.token_files import read_token_files, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_files_hold_what_the_library_gives(spark, awkward, no_docs):
    library = Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    docs = awkward.union(awkward.selectExpr("doc_id + 100", "concat(text, ' <|endoftext|>  é  x')", *awkward.columns[2:]))
    folder, parts = write_token_files(docs.repartition(3), PATH, end_id=2)
    got = read_token_files(spark, folder, parts, PATH).collect()
    ids = {}
    for r in docs.collect():
        e = library.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        ids.setdefault(r["doc_id"], []).append((len(e), zlib.crc32(np.array(e, "<u4").tobytes())))
    assert len(got) == docs.count()
    order = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and (r["n_tokens"], r["ids_crc32"]) in ids[r["doc_id"]]
        at += r["n_tokens"]
    size = sum(os.path.getsize(f"{folder}/{p['path']}.bin") for p in parts)
    assert size == 2 * at
    folder, parts = write_token_files(no_docs, PATH)
    assert parts == [] and read_token_files(spark, folder, parts, PATH).collect() == []


def test_special_strings_as_the_untouched_library_has_them(spark):
    library = Tokenizer.from_file(PATH)
    texts = ["hi <|endoftext|> you", "<|endoftext|>", "a  <|endoftext|>b<|endoftext|> é 漢<|endoftext|>\n x", "<|endoftext", "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    folder, parts = write_token_files(docs, PATH, end_id=2, special_as_text=False)
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in read_token_files(spark, folder, parts, PATH).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t, add_special_tokens=False).ids + [2]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert 50256 in library.encode(texts[0], add_special_tokens=False).ids
