from __future__ import annotations

import zlib

import numpy as np
import pytest

from trialguard.llm import token_records as t
from trialguard.llm.common import shared_path
from trialguard.llm.queries import tokenizer_file

TEXTS = [
    None, "", " \n", "Hello, World! It's John's, they'll go", "Éa'll don't x<|endoftext|>y A\x1cb ΣΑΣ. İstanbul! ñ́ ﬁne 中文字 １２ a1b2",
    "  z q. Ǆx ß ẞ. é́x, \U0001f600ok!! aa--bb '' 'S 'LL", "̈́x ŉn 𝔘nicode ªº², ⅷ Ⅷ. a_b __ d'd 'D.", "Une phrase très, très longue; " * 3000,
    "The THE the. ТЕСТ тест, ΟΔΟΣ οδος", "Hello, World! It's John's, they'll go",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))


@pytest.fixture
def docs(spark):
    ids = [7, 3, 9, 1, 8, 2, 50, 40, 30, None]
    return spark.createDataFrame([(i, x, 5) for i, x in zip(ids, TEXTS, strict=True)], "doc_id long, text string, part int").repartition(3)


def test_encoder_gives_the_ids_of_whole_texts(library):
    encoder = t.Encoder(tokenizer_file("word_bpe_49k.json"))
    assert encoder.by_piece
    for text in TEXTS:
        want = library.encode(text or "", add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == want, text
    whole = t.Encoder(tokenizer_file("byte_bpe_50k.json"))  # another pattern: texts are encoded whole
    assert not whole.by_piece
    want = whole.tokenizer.encode(TEXTS[3], add_special_tokens=False).ids
    assert np.frombuffer(whole.encode(TEXTS[3]), "<u2").tolist() == want


def test_records_read_back(docs, library):
    rows = sorted(t.token_records(docs, tokenizer_file("word_bpe_49k.json")).collect(), key=lambda r: r.start)
    source = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id))
    at = 0
    assert len(rows) == len(source)
    for r, d in zip(rows, source, strict=True):
        ids = np.array([*library.encode(d.text or "", add_special_tokens=False).ids, t.END_ID], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_any_record_can_be_read_alone_and_damage_is_found(spark, docs):
    folder = shared_path(spark, "records")
    manifest = t.write_records(docs, tokenizer_file("word_bpe_49k.json"), folder)
    files = manifest.orderBy("part").collect()
    got = [t.read_record(f.path, k) for f in files for k in reversed(range(f.records))]
    assert {i for i, _ in got} == {r.doc_id for r in docs.collect()} and all(ids[-1] == t.END_ID for _, ids in got)
    path = files[0].path.removeprefix("file:") + ".rec"
    with open(path, "r+b") as f:
        f.seek(30)
        byte = f.read(1)
        f.seek(30)
        f.write(bytes([byte[0] ^ 1]))
    with pytest.raises(t.CorruptRecord):
        [t.read_record(files[0].path, k) for k in range(files[0].records)]
    with pytest.raises(Exception, match="checksum"):
        t.read_records(spark, manifest).collect()


def test_empty_table(docs):
    assert t.token_records(docs.where("doc_id = 1000"), tokenizer_file("word_bpe_49k.json")).collect() == []
