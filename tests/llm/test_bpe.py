import base64
import hashlib
import random

import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken

from tabwright.llm.bpe import Coder, digest, encoded
from tabwright.llm.pieces import cut

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_same_ids_as_the_library(library):
    random.seed(4)
    texts = ["", None, "=" * 3000, "a" * 1501, "ha" * 300, "l'été it's  x 　 <|endoftext|> z", "\x00\x7f"]
    texts += ["".join(random.choice("abcé'. \n漢=-0\t\xa0") for _ in range(random.randint(0, 120))) for _ in range(300)]
    coder = Coder(PATH, public_tokenizers.PATTERN)
    ids, at = coder.encode(pa.array(texts))
    for k, t in enumerate(texts):
        assert ids[at[k] : at[k + 1]].tolist() == library.encode_ordinary(t or "")
    assert coder.decode(ids, at) == [(t or "").encode() for t in texts]


def test_pieces_join_to_the_text():
    texts = ["a  b", " a", "x   y \n z ", "", " a b", None]
    pieces, codes, offsets = cut(pa.array(texts))
    pieces = pieces.to_pylist()
    for k, t in enumerate(texts):
        assert "".join(pieces[c] for c in codes[offsets[k] : offsets[k + 1]]) == (t or "")


def test_rows(library, awkward, no_docs):
    texts = {(r["doc_id"], r["text"] or "") for r in awkward.collect()}
    rows = digest(awkward, PATH, public_tokenizers.PATTERN).collect()
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows}
    assert len(rows) == awkward.count()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {(i, len(e := library.encode_ordinary(t)), sha(",".join(map(str, e))), sha(t)) for i, t in texts}
    assert got == want
    whole = encoded(awkward, PATH, public_tokenizers.PATTERN).collect()
    assert {(r["doc_id"], bytes(r["decoded"]).decode()) for r in whole} == texts
    assert digest(no_docs, PATH, public_tokenizers.PATTERN).collect() == []
