"""Jaccard join, decontamination, personal data: against brute force, with every odd case."""

import hashlib
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from collections import Counter  # noqa: E402

import helpers as h  # noqa: E402
import pytest  # noqa: E402

from barloom.llm import decontamination, jaccard_join, pii  # noqa: E402

DATA = "/root/testdata/sf0.001"


def counted(rows):
    return Counter(tuple(r) for r in rows)


def near_copies(group: int, copies: int, changes: int):
    """Copies of one text with some words changed in each, so that their likeness lies around the limit."""
    base = h.prose(100 + group, 150).split()
    out = []
    for c in range(copies):
        w = list(base)
        for k in range(c % changes):
            w[(17 * c + 29 * k) % 150] = f"new{group}x{c}x{k}"
        out.append(" ".join(w))
    return out


def test_jaccard_join_against_all_pairs(spark):
    rows = h.odd_rows()
    texts = [t for g in range(4) for t in near_copies(g, 30, 6)] + near_copies(9, 60, 3)
    passage = " ".join(h.prose(77, 60).split())
    texts += [f"{h.prose(200 + i, 40 + i)} {passage} {h.prose(300 + i, 30)}" for i in range(60)]
    rows = rows + [(100 + i, t, "en", "s", len(t), 0, 0, "d", "a", "r") for i, t in enumerate(texts)]
    got = jaccard_join.similarity_components(h.frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert counted(got) == counted(h.jaccard_components([r[:2] for r in rows]))


def test_jaccard_join_splits_regions_again(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "OPEN_FACTOR", 0)
    rows = [(i, t, "en", "s", 0, 0, 0, "d", "a", "r") for i, t in enumerate(near_copies(3, 40, 9) + near_copies(4, 40, 5))]
    got = jaccard_join.similarity_components(h.frame(spark, rows)).select("doc_id", "n_shingles", "component_id").collect()
    assert counted(got) == counted(h.jaccard_components([r[:2] for r in rows]))


def edited(seed, words, *changes):
    out = h.prose(seed, words).split()
    for i in changes:
        out[i] = "changed"
    return " ".join(out)


def test_jaccard_join_links_rows_without_an_id(spark):
    rows = [(None, edited(81, 120)), (7, edited(81, 120, 60)), (5, edited(81, 120, 60, 90)), (None, edited(82, 120)), (None, edited(82, 120, 9))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.similarity_components(docs).select("doc_id", "n_shingles", "component_id", "label").collect()
    assert Counter(tuple(r)[:3] for r in got) == Counter(h.jaccard_components(rows))
    assert len({r["label"] for r in got}) == 2
    assert sorted((r["doc_id"] or 0) for r in jaccard_join.keep_one_per_component(docs).collect()) == [0, 5]


def test_jaccard_links_against_all_pairs(spark):
    rows = [r[:2] for r in h.odd_rows()] + [(100 + k, edited(83, 150, *range(0, 9 * k, 9))) for k in range(6)] + [
        (None, edited(83, 150, 70)), (120, edited(83, 150)), (121, edited(84, 50)), (122, edited(84, 50, 49))]
    links, counts = jaccard_join.similarity_links(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    sets = {}
    for i, t in rows:
        if h.shingles(t):
            sets.setdefault(frozenset(h.shingles(t)), []).append(i)
    near = {a: [b for b in sets if a != b and 100 * len(a & b) >= 80 * len(a | b)] for a in sets}
    least = {a: min((i for i in ids if i is not None), default=None) for a, ids in sets.items()}
    pair = lambda i, j, s: (*sorted([i, j], key=lambda x: (x is None, x or 0)), round(s, 6))      # noqa: E731
    want = Counter(pair(least[a], least[b], len(a & b) / len(a | b)) for a in near for b in near[a])
    got = links.collect()
    assert Counter(pair(r["doc_a"], r["doc_b"], r["similarity"]) for r in got) == Counter({k: n // 2 for k, n in want.items()})
    assert len(got) == len({(r["a"], r["b"]) for r in got}) > 10
    assert Counter((r["doc_id"], r["n_links"]) for r in counts.collect()) == Counter(
        (i, len(near[frozenset(h.shingles(t))]) if h.shingles(t) else 0) for i, t in rows)
    assert [x.count() for x in jaccard_join.similarity_links(h.empty(spark))] == [0, 0]


def test_jaccard_join_keeps_one_of_each_group(spark):
    kept = jaccard_join.keep_one_per_component(h.frame(spark, h.odd_rows()))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "point", "content", "drop", "all", "row"]
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter([1, 4, 5, 6, 7, 8, 9, 10, 11, 13, 13, 14, 15, 16, None])
    assert jaccard_join.keep_one_per_component(h.empty(spark)).count() == 0


def contract_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", h.lower(text))


def contaminated(rows, items):
    windows = {}
    for item, text in items:
        w = contract_words(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows.setdefault(tuple(w[i:i + 13]), set()).add(str(item))
    out = []
    for doc_id, text in rows:
        w, hit, found = contract_words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[key]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string").withColumn("window", decontamination.F.lit(1))


def test_decontamination_against_brute_force(spark):
    passage = h.prose(50, 40)
    items = [(1, passage), (2, h.prose(51, 13)), (3, "one"), (4, None), (5, " ... "), (6, "Éa ÀB Ñ"), (7, passage), (7, passage)]
    rows = h.odd_rows() + [
        (200, f"{h.prose(60, 100)} {passage.upper()} {h.prose(61, 30)}", "en", "s", 0, 0, 0, "d", "a", "r"),
        (201, f"{h.prose(62, 3000)}; {h.prose(51, 13).replace(' ', ', ')}! {h.prose(63, 20)}", "en", "s", 0, 0, 0, "d", "a", "r"),
        (202, h.prose(50, 12), "en", "s", 0, 0, 0, "d", "a", "r")]
    docs = h.frame(spark, rows)
    for chosen in (items, [i for i in items if i[0] != 3], items[1:2], []):
        got = decontamination.contamination(docs, bench(spark, chosen)).select(
            "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()
        assert counted(got) == counted(contaminated([r[:2] for r in rows], chosen))
    assert decontamination.contamination(h.empty(spark), bench(spark, items)).count() == 0


def test_decontamination_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "MAX_WINDOWS", 0)
    rows = [(1, f"{h.prose(60, 30)} {h.prose(50, 40)}"), (2, h.prose(61, 30))]
    got = decontamination.contamination(spark.createDataFrame(rows, "doc_id long, text string"), bench(spark, [(1, h.prose(50, 40))]))
    assert [tuple(r)[:1] + tuple(r)[2:4] for r in got.orderBy("doc_id").collect()] == [(1, 70, 40), (2, 30, 0)]


def test_decontamination_removes_documents_and_spans(spark):
    rows = [(1, f"{h.prose(60, 30)} {h.prose(50, 40)}"), (2, f"Start. {h.prose(61, 900)}; {h.prose(50, 20)}, Tail end!"),
            (3, h.prose(62, 30)), (4, None)]
    docs = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in rows], "doc_id long, text string, `drop` string, spans string, n_chars long")
    out = {r["doc_id"]: r for r in decontamination.remove_contamination(docs, bench(spark, [(1, h.prose(50, 40))])).collect()}
    assert sorted(out) == [2, 3, 4] and out[3]["text"] == rows[2][1] and out[4]["text"] is None
    assert out[2]["text"] == f"Start. {h.prose(61, 900)}, Tail end!" and out[2]["n_chars"] == len(out[2]["text"])
    assert out[3]["drop"] == "x" and out[3]["n_chars"] == 1


PERSONAL = [
    "mail a.b+c@x-y.example.com, or _d@e.f.g! a@b@c.dd x@y e.f@g..h", "12.34.56.78 and 1.2.3.4.5 300.1.1.1 0012.001.1.255 1.2.3",
    "4111 1111 1111 1111 or 4111-1111-1111-1112, 5555555555554444 and 4 1 1 1", "+1 (555) 010-2030 +49 30 +1234567890123456 +1-2(((3 456 789 01",
    "é😀ü me@ex.org 😀 1.1.1.1 +44 20 7946 0958\n4111111111111111", "a" * 5000 + "@" + "b" * 5000 + ".com", "9" * 4000, "1." * 3000, "", None,
    "x@y.zz" * 50,
]


def test_base_spans_against_the_plain_patterns(spark):
    rows = [(i, t) for i, t in enumerate(PERSONAL)] + [(4, PERSONAL[4]), (None, PERSONAL[4])] + [r[:2] for r in h.odd_rows()]
    docs = spark.createDataFrame([(*r, "q", "z") for r in rows], "doc_id long, text string, `all` string, value string").repartition(3)
    got = pii.report(docs, pii.find_personal_data(docs)).collect()
    want = []
    for doc_id, text in rows:
        spans = h.base_spans(text)
        told = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        n = Counter(k for k, _, _ in spans)
        want.append((doc_id, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(told.encode()).hexdigest()))
    assert counted([tuple(r)[:6] for r in got]) == counted(want)
    assert pii.report(h.empty(spark), pii.find_personal_data(h.empty(spark))).count() == 0


def test_terms_that_disclose_an_entity_are_generalised(spark):
    texts = [f"{h.prose(i, 30)} Falconer wrote to boss@firm.example.com about {h.prose(40 + i, 30)}" for i in range(4)]
    texts += [h.prose(90 + i, 60) for i in range(40)] + ["ask falconer, not the others"]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, row string")
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
    assert clean[0] == texts[0].replace("Falconer", "[TERM]").replace("wrote", "[TERM]").replace(" to ", " [TERM] ").replace(
        "about", "[TERM]").replace("boss@firm.example.com", "[EMAIL]")
    assert clean[44] == "ask [TERM], not the others"
    assert all(clean[i] == texts[i] for i in range(4, 44))
    spans = pii.report(docs, pii.find_personal_data(docs)).where("doc_id = 44").first()["spans"]
    assert spans == "term:4:12"


def test_terms_far_from_the_entity_and_in_repeated_rows(spark):
    far = " ".join(["filler"] * 70)         # some 490 characters
    texts = [f"{h.prose(i, 20)} Holloway 770412 {far} {h.prose(30 + i, 20)} card 4111 1111 1111 1111" for i in range(4)]
    texts += [f"{far} {h.prose(90 + i, 40)}" for i in range(60)] + ["holloway and 770412"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(0, texts[0])] * 5 + [(None, texts[1])] * 3 + [(-1, texts[1]), (500, texts[2])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = pii.find_personal_data(docs)
    spans = {r["doc_id"]: r["spans"] for r in pii.report(docs, found).collect()}
    assert spans[64] == "term:0:8,term:13:19"
    assert "term:" in spans[0] and "term:" in spans[500] and not any(spans[i] for i in range(4, 64))


@pytest.mark.parametrize("name", ["op4_decontamination", "op9_merkle_audit", "op10_jaccard_join", "op8_pii_disclosure"])
def test_oracles_on_given_tables(spark, name):
    import duckdb
    from barloom.llm import queries
    if name not in queries.ORACLES:
        pytest.skip("no oracle")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    found = con.execute(queries.ORACLES[name])
    columns = [d[0] for d in found.description]
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(columns) == sorted(got.columns)
    assert counted(got.select(*columns).collect()) == counted(found.fetchall())
