import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from retailpulse.llm.packing import CapacityTree, Packer, pack_documents
from retailpulse.llm.queries import REGISTRY
from retailpulse.llm.tokens import Encoder, default_tokenizer, words_of

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    return Encoder(default_tokenizer()).tokenizer


def ids_of(plain, text):
    return np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")


def test_encoder_equals_library(plain):
    rng, enc = random.Random(1), Encoder(default_tokenizer())
    for letters in (" \n\t ab'sé1.,\x1c  \u0085ſß中😀", ["ab", "\n", " ", ".", ",", "é", " The", "'s", "\n\n"]):
        for _ in range(3000):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 10)))
            ids, _ = next(enc.encode([text]))
            assert ids.tolist() == ids_of(plain, text).tolist(), text
    assert "".join(" " * (k > 0) + w for k, w in enumerate(words_of("a  b \n c"))) == "a  b \n c"


def test_capacity_tree_is_tightest():
    rng, tree, held = random.Random(2), CapacityTree(64), []
    for step in range(2000):
        if held and rng.random() < 0.5:
            need = rng.randint(1, 64)
            found, fits = tree.take_tightest(need), [c for c, _ in held if c >= need]
            assert (found is None) == (not fits)
            if found:
                assert found[0] == min(fits)
                held.remove(found)
        else:
            held.append((rng.randint(1, 64), step))
            tree.put(*held[-1])


def check(rows, texts, plain, window=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    for doc, text in texts.items():
        want, at = ids_of(plain, text), 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(want))
            assert r["token_ids"] == want[at:at + r["length"]].tobytes()
            at += r["length"]
        assert at == len(want)
    padded = 0
    for pieces in by_sequence.values():
        used = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == used
            used += r["length"]
        assert 0 < used <= window
        padded += 0 if used & (used - 1) == 0 else window - used
    return padded / max(1, sum(r["length"] for r in rows))


def test_pieces_are_exact_and_full(spark, documents, texts, plain):
    assert check(pack_documents(documents).collect(), texts, plain) < 0.01


def test_query_digests(spark, texts, plain):
    for r in REGISTRY["op1_packing"](spark, SF).collect():
        ids = ids_of(plain, texts[r["doc_id"]])[r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_awkward_rows(spark, awkward, plain):
    rows = pack_documents(awkward.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])).collect()
    texts = {r["doc_id"]: r["text"] for r in awkward.collect() if r["doc_id"] is not None}
    check(rows, texts, plain)
    assert sum(r["length"] for r in pack_documents(awkward).collect()) == sum(
        len(ids_of(plain, r["text"])) for r in awkward.collect())


def test_empty_table(spark, no_documents):
    assert pack_documents(no_documents).count() == 0


def test_pieces_that_never_pair():
    packer = Packer(1024, 64, 8)
    out = [s for i in range(200) for s in packer.add(i, np.full(600, i, dtype=np.uint32))]
    out += list(packer.finish())
    assert sum(len(p[2]) for s in out for p in s) == 200 * 600
    used = [sum(len(p[2]) for p in s) for s in out]
    assert all(u > 1015 or u & (u - 1) == 0 for u in used)
