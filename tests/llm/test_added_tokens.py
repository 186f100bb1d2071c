"""Names of added tokens in texts, against the ``tokenizers`` file as it stands."""

import zlib

import numpy as np

from brightledger.llm import packing

TEXTS = [
    "x <|endoftext|> y", "<|endoftext|>", "<|endoftext|><|endoftext|>", "one two<|endoftext|>three  four", "a\n<|endoftext|>\n b", "no token here",
    "<|endoftext| >", "<|endof<|endoftext|>text|>", " <|endoftext|> ",
]


def test_names_of_added_tokens(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: [*e.ids, packing.END_ID] for i, e in enumerate(t.encode_batch(TEXTS, add_special_tokens=False))}
    assert want[0][:-1] == [87, 220, 50256, 331]
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = packing.packed_documents(docs).collect()
    crc = {i: zlib.crc32(np.array(ids, "<u4").tobytes()) for i, ids in want.items()}
    assert {r.doc_id: (r.length, r.ids_crc32) for r in got} == {i: (len(ids), crc[i]) for i, ids in want.items()}
