import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from retailpulse.llm import alignment as A
from retailpulse.llm.common import packed, unpacked
from retailpulse.llm.queries import REGISTRY

SF = "/root/testdata/sf0.001"
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
SPARE = "doc_id long, text string, key long, k int, block long, pairs string"


@pytest.fixture(scope="module")
def tool():
    return A.Aligner(A.default_tokenizer(), A.default_pieces())


def plain(tool, text):
    """(groups, links) of a whole text by the two libraries; None without tokens."""
    raw = (" " + (text or "")).encode()
    a = tool.a.tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
    b = tool.b.encode(text) if text else []
    joined = [b"".join(entry[i] for i in ids) for ids, entry in ((a, tool.a_bytes), (b, tool.b_bytes))]
    if not text or joined != [raw, raw]:
        return None
    groups, links, i, j, at_a, at_b, cur = [], [], 0, 0, 0, 0, ([], [])
    while i < len(a) or j < len(b):
        if j == len(b) or (i < len(a) and at_a + len(tool.a_bytes[a[i]]) <= at_b + len(tool.b_bytes[b[j]])):
            at_a, i = at_a + len(tool.a_bytes[a[i]]), i + 1
            cur[0].append(a[i - 1])
        else:
            at_b, j = at_b + len(tool.b_bytes[b[j]]), j + 1
            cur[1].append(b[j - 1])
        if at_a == at_b:
            groups.append(cur)
            links.append((cur[0][-1], cur[1][-1]))
            cur = ([], [])
    return groups, links


def expected(tool, texts):
    found = [plain(tool, t) for t in texts]
    counts = Counter(x for f in found if f for x in f[1])
    most = {}
    for (_, b), n in counts.items():
        most[b] = max(most.get(b, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        groups, links = f
        shown = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(counts[x] == most[x[1]] for x in links), sum(counts[x] for x in links),
                    hashlib.sha256(shown.encode()).hexdigest()))
    return out


def same(df, ids, want):
    got = sorted((str(r["doc_id"]), *(r[n] for n in NAMES)) for r in df.collect())
    assert got == sorted((str(i), *w) for i, w in zip(ids, want))


def letters(rng, n):
    some = rng.choice([" \n\t ab'sé1.,\x1c  \u0085ſß中😀\x00", "▁ ab", ["ab", "\n", " ", "é", " The", "'s", "<s>",
                       "<|endoftext|>", "<0x0A>", "wonder", "fully", "   "]])
    return "".join(rng.choice(some) for _ in range(n))


def test_words_equal_whole_texts(tool):
    rng = random.Random(1)
    for _ in range(4000):
        text = letters(rng, rng.randint(1, 14))
        a, b = tool.tokens(A.words_of(text))
        assert sum(a, []) == tool.a.tokenizer.encode(" " + text, add_special_tokens=False).ids, text
        if A.MARK not in text:
            assert sum(b, []) == tool.b.encode(text), text


def test_fragments_are_a_monoid(tool):
    """Ranges cut anywhere, joined in any order, give the groups of the whole text."""
    import numpy as np
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice(["wonder", "fully", " un", "believ", "é", "中", "1", "  ", "😀", "ing"]) for _ in range(12))
        groups, links = plain(tool, text)
        a = np.array([x for g, _ in groups for x in g])
        b = np.array([x for _, g in groups for x in g])
        ends = [np.cumsum(s[i]) for s, i in ((tool.a_size, a), (tool.b_size, b))]
        cuts = sorted({0, len((" " + text).encode()), *(rng.randint(0, 30) for _ in range(rng.randint(0, 6)))})
        parts, found = [], []
        for lo, hi in zip(cuts, cuts[1:]):
            f, pairs = A.fragment_of(a, ends[0], b, ends[1], lo, hi)
            parts.append((f, list(f.groups or [])))
            found += [tuple(x) for x in pairs.tolist()]
        assert found == links
        while len(parts) > 1:           # join two neighbours anywhere
            i = rng.randrange(len(parts) - 1)
            (x, gx), (y, gy) = parts[i:i + 2]
            f, between = A.joined(x, y)
            parts[i:i + 2] = [(f, gx + ([between] if between else []) + gy)]
        f, middle = parts[0]
        shown = [A.group_text(f.pre_a, f.pre_b), *middle]
        assert shown == [A.group_text(*g) for g in groups] and not f.suf_a and not f.suf_b
        for x, _ in parts:
            assert A.joined(A.EMPTY, x)[0] == x and A.joined(x, A.EMPTY)[0] == x


def test_ranges_cover_every_byte_once():
    rng = random.Random(3)
    for _ in range(400):
        text = letters(rng, rng.randint(1, 200))
        at = 0
        for window, lo, hi in A.ranges_of(text, 16):
            raw = (" " + window).encode()
            assert (" " + text).encode()[at:at + hi - lo] == raw[lo:hi]
            at += hi - lo
        assert at == len((" " + text).encode())


def test_query_on_table(spark, tool):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    same(REGISTRY["op12_alignment"](spark, SF), [r["doc_id"] for r in rows], expected(tool, [r["text"] for r in rows]))


@pytest.mark.parametrize("long, chunk, chars", [(20, 7, 60), (50, 30, 10 ** 6), (10 ** 6, 10 ** 6, 500)])
def test_awkward_rows(spark, tool, long, chunk, chars):
    """Ranges of every size give what whole texts give; rows that are not given back count nowhere."""
    rng = random.Random(long)
    texts = [None, "", " ", "  ", "a", "same text", "same text", "x▁y", "fine words here " * 9 + "▁ more words here",
             "wonderfully " * 40, "unbreakable" * 60, "中文字符" * 50, "tail  \n\n ", "<s> </s> <|endoftext|> <0x0A>"]
    texts += [letters(rng, rng.randint(0, 300)) for _ in range(40)]
    ids = [None if i % 11 == 0 else i % 30 for i in range(len(texts))]
    df = spark.createDataFrame([(i, t, 1, 2, 3, "p") for i, t in zip(ids, texts)], SPARE)
    same(A.align_documents(df, long=long, chunk=chunk, block_chars=chars), ids, expected(tool, texts))


def test_very_long_text_lies_in_many_tasks(spark, tool):
    rng = random.Random(9)
    text = " ".join(rng.choice(["alpha", "Betaverse", "γάμμα", "delta,", "x1", "unbelievably"]) for _ in range(60_000))
    df = spark.createDataFrame([(1, text), (2, "alpha delta,")], "doc_id long, text string")
    blocks = A.aligned_blocks(df, long=5000, chunk=5000)
    assert blocks.where("key is not null").count() > A.FAN ** 2
    same(A.align_documents(df, long=5000, chunk=5000), [1, 2], expected(tool, [text, "alpha delta,"]))


def test_empty_table(spark):
    df = spark.createDataFrame([], SPARE)
    assert A.align_documents(df).collect() == []


def test_groups_as_output(spark, tool):
    text = "wonderfully unbelievable"
    df = spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string")
    row = A.aligned_blocks(df.coalesce(1), keep_groups=True).first()
    shown = ";".join(A.group_text(*g).decode() for g in plain(tool, text)[0])
    assert [bytes(g).decode() for g in row["groups"]] == [shown, ""]


def test_pair_counts_come_back_as_rows(spark, documents, monkeypatch):
    """No list of a block's pairs is gathered on the heap; blocks come with counts in any order."""
    def gathered(*_):
        raise AssertionError("gathered")
    whole = {r["doc_id"]: r for r in A.align_documents(documents).collect()}
    monkeypatch.setattr(A.F, "collect_list", gathered)
    assert {r["doc_id"]: r for r in A.align_documents(documents, block_chars=20_000).collect()} == whole


def test_packed_numbers():
    for values in ([], [0, 0], [3, 255, 0], [1, 1 << 40, 7], [(1 << 63) - 1]):
        assert unpacked(packed(np.array(values, dtype=np.int64))).tolist() == values
