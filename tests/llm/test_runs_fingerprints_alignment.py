"""Periodic runs, pivot SimHash links and token alignment against plain Python forms."""

import hashlib
import os
import sys
import zlib
from collections import Counter, defaultdict

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import helpers as h  # noqa: E402
import numpy as np  # noqa: E402
import public_tokenizers  # noqa: E402
import pytest  # noqa: E402
import sentencepiece  # noqa: E402
import xxhash  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from barloom.llm import periodic_runs, pivot_simhash, token_alignment  # noqa: E402
from barloom.llm.components import components  # noqa: E402


# ---- periodic runs

def plain_runs(words):
    """[(start, length, period)] by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                found.setdefault((i, length), q)        # periods ascend: the smallest stays
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def repetitive(draw):
    """Word lists that are periodic in many ways: two letters, broken periods, runs in runs, one word."""
    n, kind = draw.integers(0, 150), draw.integers(0, 5)
    if kind == 0:
        return draw.integers(0, 2, n)
    if kind == 1:
        return draw.integers(0, 40, n)
    if kind == 2:
        w = np.tile(draw.integers(0, 3, draw.integers(1, 30)), 150)[:n]
        w[draw.integers(0, max(1, n), 2 if n else 0)] = 7
        return w
    if kind == 3:
        unit = np.concatenate([np.tile(draw.integers(0, 2, 3), draw.integers(1, 9)), draw.integers(0, 4, draw.integers(0, 3))])
        return np.tile(unit, 60)[:n]
    return np.zeros(n, np.int64)


def test_runs_by_brute_force():
    draw = np.random.default_rng(5)
    for _ in range(300):
        texts = [repetitive(draw).astype(np.int64) for _ in range(draw.integers(1, 6))]
        got = list(zip(*(x.tolist() for x in periodic_runs.find(np.concatenate(texts), np.array([len(t) for t in texts])))))
        first = np.cumsum([0, *[len(t) for t in texts]])
        assert got == [(int(f) + s, n, q) for f, t in zip(first, texts) for s, n, q in plain_runs(t.tolist())]


def test_wavelet_successor():
    draw = np.random.default_rng(6)
    values = draw.permutation(500)[:300]
    tree = periodic_runs.WaveletTree(values)
    lo, hi, least = draw.integers(0, 150, 400), draw.integers(150, 301, 400), draw.integers(0, 600, 400)
    want = [min((v for v in values[a:b] if v >= x), default=-1) for a, b, x in zip(lo, hi, least)]
    assert tree.successor(lo, hi, least).tolist() == want


def run_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n and (hashed := zlib.crc32(str(doc_id).encode())) % 10 == 0:
        a = hashed // 10 % n
        p = 1 + (n - a) // (3 + hashed // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else (None,) * 3
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is not None, x) for x in r])


def odd_texts():
    """The odd rows, their long text cut for brute force in one case, and repetitive ones under ids that are planted or not."""
    rows = [(i, t if not t or len(t) < 40000 else t[:9000], *rest) for i, t, *rest in h.odd_rows()]
    more = ["a b " * 40, "x " * 500, "one two three " * 3 + "end", "A a " * 9, "\x0b".join("pq" * 8), "é ñ " * 12]
    return rows + [(100 + k, more[k % 6], None, None, None, k, k, "d", None, "r") for k in range(30)]


def test_runs_of_odd_rows(spark, tmp_path):
    rows = odd_texts()
    h.frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = periodic_runs.query(spark, str(tmp_path)).collect()
    assert ordered(got) == ordered([run_row(r[0], r[1]) for r in rows])


def test_runs_of_long_text_and_batches(spark, monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 50)
    rows = h.odd_rows()
    got = periodic_runs.periodic_runs(h.frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n"]) for r in got) == Counter((r[0], len((r[1] or "").split())) for r in rows)
    start, length, period = periodic_runs.find(np.zeros(300_000, np.int64), np.array([300_000]))
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [300_000], [1])


# ---- pivot SimHash

def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def plain_components(fps):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, x in enumerate(fps):
        for j in range(i):
            if (x ^ fps[j]).bit_count() <= 2:
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return [find(i) for i in range(len(fps))]


def test_distances_bound_and_name_differences():
    draw = np.random.default_rng(7)
    a = draw.integers(0, 2 ** 63, 500).astype(np.uint64)
    turned = np.uint64(1) << draw.integers(0, 64, (500, 2)).astype(np.uint64)
    b = a ^ turned[:, 0] ^ np.where(draw.random(500) < 0.5, turned[:, 1], np.uint64(0))
    t, u = (pivot_simhash.distance_table(x).astype(int) for x in (a, b))
    assert (np.abs(t - u).max(axis=1) <= np.bitwise_count(a ^ b)).all()
    code = np.zeros(500, np.int32)
    one, other = (pivot_simhash._keys(x, code)[1].reshape(6, 500) for x in (a, b))
    assert (one == other).any(axis=0).all()             # a close pair shares a group


def cluster(draw):
    """Fingerprints around a few centres, some in a small dense corner."""
    out = set()
    for centre in draw.integers(0, 2 ** 63, 4).tolist():
        for _ in range(120):
            x = centre
            for bit in draw.integers(0, 64, draw.integers(0, 6)).tolist():
                x ^= 1 << bit
            out.add(x)
        for _ in range(120):
            x = centre
            for bit in draw.integers(0, 10, draw.integers(0, 8)).tolist():
                x ^= 1 << bit
            out.add(x)
    return sorted(out)


@pytest.mark.parametrize("group", [4, 256])
def test_links_connect_what_is_close(spark, monkeypatch, group):
    monkeypatch.setattr(pivot_simhash, "GROUP", group)
    fps = cluster(np.random.default_rng(8))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    edges = pivot_simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3))
    label = {r["node"]: r["label"] for r in components(edges).collect()}
    want, got = defaultdict(set), defaultdict(set)
    for x, c in zip(signed, plain_components(fps)):
        want[c].add(x)
        got[label.get(x, x)].add(x)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


def check_simhash(rows, got):
    fps = [plain_fingerprint(r[1]) for r in rows]
    label, least = plain_components(fps), {}
    for (doc_id, *_), c in zip(rows, label):
        if doc_id is not None:
            least[c] = min(least.get(c, doc_id), doc_id)
    assert ordered(got) == ordered([(r[0], f"{x:016x}", least.get(c)) for r, x, c in zip(rows, fps, label)])


def test_simhash_of_odd_rows(spark, tmp_path):
    rows = h.odd_rows()
    long_text = " ".join(h.prose(50, 3000).split())
    near = long_text.split()
    near[1500] = "changed"
    rows += [(200, long_text, *rows[0][2:]), (201, " ".join(near), *rows[0][2:]), (None, long_text.upper(), *rows[0][2:])]
    h.frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    check_simhash(rows, pivot_simhash.query(spark, str(tmp_path)).collect())


def test_simhash_beyond_broadcast_bounds(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pivot_simhash, "MAX_BROADCAST", 2)
    monkeypatch.setattr(pivot_simhash, "HOT_ROWS", 3)
    monkeypatch.setattr(pivot_simhash, "GROUP", 2)
    rows = h.odd_rows()
    h.frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    check_simhash(rows, pivot_simhash.query(spark, str(tmp_path)).collect())


# ---- token alignment

def byte_values():
    """Byte of each character of a byte-level vocabulary: printable ones stand for themselves, others follow 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def plain_alignment(rows):
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    value, found, holders = byte_values(), [], defaultdict(set)
    for at, (doc_id, text, *_) in enumerate(rows):
        a = whole.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        bytes_a = [bytes(value[c] for c in whole.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else
                   pieces.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not text or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            found.append((doc_id, [], [], [], []))
            continue
        of_a = [k for k, t in enumerate(bytes_a) for _ in t]        # token of every byte
        of_b = [k for k, t in enumerate(bytes_b) for _ in t]
        links = [(a[i], b[j]) for i, j in sorted(set(zip(of_a, of_b)))]
        groups, i, j = [], 0, 0
        for k in range(len(of_a)):
            if k + 1 == len(of_a) or of_a[k] != of_a[k + 1] and of_b[k] != of_b[k + 1]:
                groups.append((a[i:of_a[k] + 1], b[j:of_b[k] + 1]))
                i, j = of_a[k] + 1, of_b[k] + 1
        for pair in links:
            holders[pair].add(at)
        found.append((doc_id, a, b, groups, links))
    most = Counter()
    for (x, _), docs in holders.items():
        most[x] = max(most[x], len(docs))
    out = []
    for doc_id, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(len(holders[p]) == most[p[0]] for p in links),
                    sum(len(holders[p]) for p in links), text))
    return out, holders


def alignment_rows():
    more = ["<|endoftext|> and <s> </s> <0x41> here", "tab\tnew\nline  double   spaces ", "▁ piece mark", "日本語のテキスト 中文 한국어",
            "emoji 🙂🙃 zero​width", "é combining Ⅷ ﬁ", " leading", "\x00\x01 control \x7f", "naïve façade" * 3, "a" * 12000]
    return [(i, t if not t or len(t) < 40000 else t[:20000], *rest) for i, t, *rest in h.odd_rows()] + [
        (300 + k, t, None, None, None, k, k, "d", None, "r") for k, t in enumerate(more)]


@pytest.mark.parametrize("chunk", [64, 4 << 20])
def test_alignment_of_odd_rows(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(token_alignment, "CHUNK_POSTINGS", chunk)
    monkeypatch.setattr(token_alignment, "SLICE_BYTES", 3000)
    rows = alignment_rows()
    h.frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    want, _ = plain_alignment(rows)
    whole = token_alignment.align(h.frame(spark, rows), digest=False)
    assert ordered(whole.collect()) == ordered(want)
    digests = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in want]
    assert ordered(token_alignment.query(spark, str(tmp_path)).collect()) == ordered(digests)


def test_pair_counts(spark):
    rows = [(i, t, None, None, None, 0, 0, "d", None, "r") for i, t in enumerate(["the cat the cat", "the dog", "a cat", "the the the the"])]
    found, holders = plain_alignment(rows)
    got = {(r["a"], r["b"]): (r["documents"], r["links"]) for r in token_alignment.pair_counts(
        token_alignment.written(token_alignment.segments(h.frame(spark, rows)), "t")).collect()}
    assert {p: n for p, (n, _) in got.items()} == {p: len(d) for p, d in holders.items()}
    assert sum(n for _, n in got.values()) == sum(r[4] for r in found) > len(got)


def test_planes_round_trip():
    draw = np.random.default_rng(9)
    for n_docs in (1, 9, 200, 5000):
        member = np.sort(draw.integers(0, 40, 3000) ** 2 // 40)
        number = draw.integers(0, n_docs, 3000)
        key = np.unique(member.astype(np.int64) << 16 | number)
        plane = token_alignment.pack_plane(key >> 16, key & 0xFFFF, n_docs)
        back = token_alignment.unpack_plane(plane, n_docs)
        assert sorted(zip(*map(np.ndarray.tolist, back))) == sorted(zip((key >> 16).tolist(), (key & 0xFFFF).tolist()))


def test_empty_tables(spark, tmp_path):
    h.empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    for module in (periodic_runs, pivot_simhash, token_alignment):
        assert module.query(spark, str(tmp_path)).count() == 0
