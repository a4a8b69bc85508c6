"""Classifiers on held-out rows; packing, sketches, audits and linking by round trips and brute force."""

import hashlib
import json
import os
import sys
import zlib

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from collections import Counter, defaultdict  # noqa: E402

import helpers as h  # noqa: E402
import numpy as np  # noqa: E402
import pytest  # noqa: E402

from barloom.llm import (language_kernel, merkle_audit, packing, quality_cnn, scaled_sketch, tool_linking,  # noqa: E402
                         toxicity_fm)
from barloom.llm.common import shingle_hashes, table, word_hashes  # noqa: E402

DATA = "/root/testdata/sf0.01"


def auc(truth, score):
    rank = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    truth = np.array(truth)
    n = truth.sum()
    return (rank[truth == 1].sum() - n * (n - 1) / 2) / (n * (len(truth) - n))


def test_hashes_depend_on_words_alone():
    a, b = word_hashes("One  two\tTHREE ".encode()), word_hashes(b"one two three")
    assert (a == b).all() and len(set(a.tolist())) == 3 and not len(word_hashes(b" \n"))
    assert len(shingle_hashes(b"a b c d")) == 1 and len(shingle_hashes(b"a b c d e f")) == 2
    assert shingle_hashes(b"a b")[0] != shingle_hashes(b"b a")[0]


def labelled(spark, column):
    docs, labels = table(spark, DATA, "documents"), table(spark, DATA, "labels")
    return docs, labels, {r["doc_id"]: r[column] for r in labels.collect()}


def test_toxicity_on_held_out_rows(spark):
    docs, labels, marks = labelled(spark, "toxic")
    rows = toxicity_fm.detect_toxicity(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (h.remainder(r["doc_id"], 5) == 0) for r in rows)


def test_toxicity_auc_on_held_out_rows(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    marks = {r["doc_id"]: r["toxic"] for r in labels.where("toxic IS NOT NULL").collect()}
    rows = toxicity_fm.detect_toxicity(docs, labels).where("held_out").collect()
    rows = [r for r in rows if r["doc_id"] in marks]
    assert auc([marks[r["doc_id"]] for r in rows], [r["score"] for r in rows]) > 0.95


def test_toxicity_learns_pairs():
    draw = np.random.default_rng(3)
    pair = [(a, b) for a in (0, 1) for b in (0, 1)] * 300
    sets = [np.array(sorted({*([10] if a else []), *([20] if b else []), *draw.integers(100, 130, 5)}), np.int32) for a, b in pair]
    labels = np.array([int(a and b) for a, b in pair])
    model = toxicity_fm.fit(sets, labels, epochs=20)
    plain = model.margin(np.array([10], np.int32)), model.margin(np.array([20], np.int32))
    assert model.margin(np.array([10, 20], np.int32)) > 0 > max(plain)


def test_toxicity_learns_pairs_of_neutral_terms():
    draw = np.random.default_rng(9)
    kinds = [(a, b) for a in (0, 1) for b in (0, 1)] * 400
    sets = [np.array(sorted({*([10] if a else []), *([20] if b else []), *draw.integers(1000, 4000, 30)}), np.int32) for a, b in kinds]
    labels = np.array([int(a == b) for a, b in kinds])      # each term alone is as often toxic as not
    model = toxicity_fm.fit(sets[:1200], labels[:1200])
    assert np.mean([(model.margin(s) > 0) == y for s, y in zip(sets[1200:], labels[1200:])]) > 0.9


def test_toxicity_telling_pairs_by_brute_force():
    draw = np.random.default_rng(4)
    sets = [np.unique(draw.integers(0, 25, 8)).astype(np.int32) for _ in range(400)]
    rest, spread = draw.normal(0, 0.4, 400) + [0.8 * (3 in s and 7 in s) for s in sets], draw.uniform(0.02, 0.2, 400)
    want = set()
    for a in range(25):
        for b in range(a):
            both = np.array([a in s and b in s for s in sets])
            if abs(rest[both].sum()) >= 3 and abs(rest[both].sum()) >= 4 * np.sqrt(spread[both].sum()):
                want |= {a, b}
    assert {3, 7} <= want and set(toxicity_fm.telling_pairs(sets, rest, spread, z=4).tolist()) == want


def test_quality_on_held_out_rows(spark):
    docs, labels, marks = labelled(spark, "quality")
    rows = quality_cnn.rate_quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in marks]
    assert all(r["held_out"] == (h.remainder(r["doc_id"], 4) == 2) for r in rows)
    assert auc([marks[r["doc_id"]] for r in held], [r["score"] for r in held]) > 0.9


def test_caps_do_not_move_the_prior(spark):
    docs = spark.createDataFrame([(i, h.prose(i, 30)) for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 > 0), int(i % 10 == 0)) for i in range(600)], "doc_id long, quality int, toxic int")
    toxic, good = toxicity_fm.detect_toxicity(docs, labels, per_label=40), quality_cnn.rate_quality(docs, labels, per_label=40)
    assert np.median([r["score"] for r in toxic.collect()]) < 0.25 and np.median([r["score"] for r in good.collect()]) > 0.75


def test_quality_pools_over_the_whole_text():
    model = quality_cnn.fit([], np.zeros(0), np.zeros(0, int))
    data = np.frombuffer(h.prose(3, 20000).encode(), np.uint8)
    n = len(data) - quality_cnn.WIDTH + 1
    plain = sum(model.tables[k][data[k:k + n]] for k in range(quality_cnn.WIDTH))
    want = np.stack([np.maximum(plain[i:i + quality_cnn.BLOCK].max(axis=0) + model.bias, 0) for i in range(0, n, quality_cnn.BLOCK)])
    np.testing.assert_allclose(model.blocks(data), want, rtol=1e-4, atol=1e-5)


def test_language_on_held_out_rows(spark):
    docs = table(spark, DATA, "documents")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = language_kernel.predict(docs).collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == len(lang) and {r["doc_id"] for r in held} == {i for i in lang if h.remainder(i, 4) == 2}
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.98


def test_language_kernel_is_the_presence_kernel():
    texts = ["the cat sat", "the dog sat", "le chat noir", "le chien noir"] * 3
    spectra, labels = [language_kernel.spectrum(t) for t in texts], ["en", "en", "fr", "fr"] * 3
    model = language_kernel.fit(spectra, labels, landmarks=6, ridge=1e-3)
    assert model.languages == ["en", "fr"]
    k = np.array([[len(np.intersect1d(a, b)) / np.sqrt(len(a) * len(b)) for b in spectra] for a in spectra])
    assert (k > 0).all() and model.margins(spectra).argmax(axis=1).tolist() == [0, 0, 1, 1] * 3
    grams = {g for t in ["ab"] for g in (" ab ", )}
    assert grams and len(language_kernel.spectrum("ab")) == 3 + 3 + 2


def test_language_stage_keeps_learned_languages_alone(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    text = {r["doc_id"]: r for r in docs.select("doc_id", "text", "lang").collect()}
    lettered = {i for i, r in text.items() if any(c.isalpha() for c in r["text"] or "")}
    assert {r["doc_id"] for r in language_kernel.keep_identified(docs).collect()} == lettered
    blind = docs.withColumn("lang", language_kernel.F.expr("if(lang = 'de', NULL, lang)"))     # three languages are learned
    kept = {r["doc_id"] for r in language_kernel.keep_identified(blind).collect()}
    german = {i for i in lettered if text[i]["lang"] == "de"}
    assert lettered - german <= kept and len(kept & german) < 0.1 * len(german)


def test_classifiers_on_odd_rows(spark):
    rows = h.odd_rows()
    docs = h.frame(spark, rows)
    labels = spark.createDataFrame([(1, 1, 0), (3, 1, 1), (4, 0, 1), (None, 0, 1), (9, None, None), (9, None, None), (10, 0, 0), (8, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    for out in (toxicity_fm.detect_toxicity(docs, labels), quality_cnn.rate_quality(docs, labels),
                toxicity_fm.detect_toxicity(docs, labels.where("false")), quality_cnn.rate_quality(docs, labels.where("false"))):
        got = out.collect()
        assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
        assert all(0 <= r["score"] <= 1 and r["held_out"] in (True, False) for r in got)
    for op in (toxicity_fm.detect_toxicity, quality_cnn.rate_quality):
        assert op(h.empty(spark), labels).count() == 0
    got = language_kernel.predict(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows)
    assert {r["doc_id"] for r in got if r["lang_pred"] == "und"} >= {5, 6, 7, 16}
    assert {r["lang_pred"] for r in language_kernel.predict(docs.withColumn("lang", language_kernel.F.lit(None).cast("string"))).collect()} == {"und"}
    kept = language_kernel.keep_identified(docs)
    assert kept.columns == docs.columns and {5, 6, 7, 16}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert language_kernel.keep_identified(h.empty(spark)).count() == 0


def pieces_fit(rows, docs):
    """Every id of every document in one piece, sequences gapless and full or a power of two."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        assert r["length"] * 4 == len(r["token_ids"]) and r["length"] > 0
    want = Counter()
    for doc_id, text in docs:
        want[doc_id, packing.token_ids(text).tobytes()] += 1
    for doc_id, got in by_doc.items():
        copies = sum(n for (d, _), n in want.items() if d == doc_id)
        assert sum(r["length"] for r in got) == sum(len(ids) // 4 * n for (d, ids), n in want.items() if d == doc_id)
        if copies == 1:
            joined = b"".join(r["token_ids"] for r in sorted(got, key=lambda r: r["start"]))
            assert want[doc_id, joined] == 1
            assert [r["start"] for r in sorted(got, key=lambda r: r["start"])] == list(np.cumsum([0, *[r["length"] for r in sorted(got, key=lambda r: r["start"])]])[:-1])
    for got in by_sequence.values():
        got.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in got] == list(np.cumsum([0, *[r["length"] for r in got]])[:-1])
        size = sum(r["length"] for r in got)
        assert size == 1024 or size < 1024 and size & (size - 1) == 0
    return len(by_sequence)


def test_packing_round_trip(spark):
    rows = [r[:2] for r in h.odd_rows()] + [(100 + i, h.prose(i, 3 + 37 * i % 900)) for i in range(300)] + [(99, "a <|endoftext|> b")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    pieces_fit(got, rows)
    few = [(i, h.prose(i, 500)) for i in range(9)]         # no multiset fills a window: pieces are cut
    pieces_fit(packing.pack(spark.createDataFrame(few * 3, "doc_id long, text string").coalesce(1)).collect(), few * 3)
    assert packing.pack(h.empty(spark)).count() == 0


def test_token_ids_are_those_of_tokenizers():
    whole = packing._whole(packing.VOCABULARY[0])
    for text in ["", "a <|endoftext|> b", "x" * 30000, " " * 20000, "Éa ñ 😀\u0000\n\n  y", h.prose(1, 500), "a\u00a0b\u2003c \x1cd\n e", "it's\n'll ", " x", "\r\n"]:
        assert packing.token_ids(text).tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0]


def test_closest_fill_against_all_subsets():
    draw = np.random.default_rng(5)
    for _ in range(60):
        lengths = draw.integers(1, 40, draw.integers(1, 9)).tolist()
        room = int(draw.integers(1, 90))
        sums = {0}
        for n in lengths:
            sums |= {s + n for s in sums if s + n <= room}
        used = packing.closest_fill(dict(Counter(lengths)), room)
        assert sum(n * k for n, k in used.items()) == max(sums)
        assert all(k <= lengths.count(n) for n, k in used.items())


def test_sketches_against_brute_force(spark):
    rows = [r[:2] for r in h.odd_rows() if r[0] is not None and r[0] not in (13, 14)] + [(20 + i, h.prose(i, 300 + i)) for i in range(40)]
    got = {r["doc_id"]: r for r in scaled_sketch.compare_with_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    order = sorted((i, t or "") for i, t in rows)
    assert sorted(got) == [i for i, _ in order]
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        new = t[:len(t) - len(t) // 4] + following[:len(t) // 4]
        r = got[i]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest()
        assert r["fingerprint"] == scaled_sketch.as_text(scaled_sketch.sketch(t))
        assert r["edited_fingerprint"] == scaled_sketch.as_text(scaled_sketch.sketch(new))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if len(t) > 2000 and len(set(t)) > 1:
            assert abs(r["near_edited"] - 0.6) < 0.3 and r["near_next"] < 0.2


def test_sketches_on_odd_rows_and_properties(spark):
    assert scaled_sketch.compare_with_edits(h.frame(spark, h.odd_rows())).count() == len(h.odd_rows())
    assert scaled_sketch.compare_with_edits(h.empty(spark)).count() == 0
    one = scaled_sketch.compare_with_edits(spark.createDataFrame([(5, "abcdefgh" * 9)], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    a, b = h.prose(1, 4000), h.prose(2, 200)
    sa, sb, both = (scaled_sketch.sketch(t) for t in (a, b, f"{a}\n{b}"))
    assert scaled_sketch.containment(sb, both) > 0.9 and scaled_sketch.containment(sa, both) > 0.95
    assert scaled_sketch.likeness(sa, sb) < 0.1 and scaled_sketch.likeness(sa, sa) == 1
    assert set(sa[sa < scaled_sketch.LIMIT]) <= set(scaled_sketch.merge(sa, sb))
    assert scaled_sketch.likeness(scaled_sketch.sketch(""), scaled_sketch.sketch(None)) == 1
    assert scaled_sketch.likeness(scaled_sketch.sketch(""), sa) == 0


def test_audit_finds_all_damage(spark):
    rows = [(i, f"http://x/{i}", h.prose(i, 20 + i % 7)) for i in range(9000, 9600)] + [
        (3, None, None), (3, None, None), (None, "u", "h"), (None, None, None), (70000, "", "")]
    schema = "page_id long, url string, html string"
    pages = spark.createDataFrame(rows, schema).withColumn("node", merkle_audit.F.lit("x"))
    changed = [(i, u, t + "!" if i in (9001, 9333) else t) for i, u, t in rows if i not in (9100, 70000)] + [(12345, "new", "page")]
    got = merkle_audit.audit(pages, spark.createDataFrame(changed, schema)).collect()
    assert Counter(r["status"] for r in got) == Counter(intact=602 - 2, corrupt=2, missing=2, extra=1)
    assert {r["page_id"]: r["status"] for r in got if r["status"] != "intact"} == {
        9001: "corrupt", 9333: "corrupt", 9100: "missing", 70000: "missing", 12345: "extra"}
    assert {r["status"] for r in merkle_audit.audit(pages, pages).collect()} == {"intact"}
    none = spark.createDataFrame([], schema)
    assert {r["status"] for r in merkle_audit.audit(pages, none).collect()} == {"missing"}
    assert merkle_audit.audit(none, none).count() == 0
    mine = [r for r in got if r["status"] != "extra" and r["page_id"] is not None]
    for f in {r["file_id"] for r in mine}:
        part = sorted((r for r in mine if r["file_id"] == f), key=lambda r: r["offset"])
        assert [r["offset"] for r in part] == list(np.cumsum([0, *[r["length"] * r["copies"] for r in part]])[:-1])


def test_linking_orders_validates_and_serialises(spark):
    ref = lambda i: {"$result": i}      # noqa: E731
    calls = [
        (1, 0, "a", "search", {"query": "q", "limit": 3}), (1, 0, "b", "lookup", {"key": "k", "after": ref("a")}),
        (1, 0, "c", "note", {"body": "x", "after": ref("b")}), (1, 1, "d", "note", {"body": "y", "after": ref("c"), "urgent": True}),
        (2, 0, "e", "note", {"body": "z", "after": ref("f")}), (2, 0, "f", "note", {"body": "z", "after": ref("e")}),
        (2, 0, "g", "note", {"body": "", "more": 1}), (2, 0, "h", "none", {}), (2, 0, "i", "search", {"query": 1, "limit": True}),
        (2, 0, "j", "note", {"body": "b", "after": ref("zz")}), (2, 0, "k", "note", {"body": "b", "after": ref("a")}),
    ]
    rows = [(c, t, i, n, json.dumps(a)) for c, t, i, n, a in calls] + [
        (3, 0, "l", "note", "{bad"), (3, 0, "m", "note", None), (3, 0, "n", "note", '{"body": NaN}'), (3, 0, None, "note", "{}"),
        (None, None, "o", "note", '{"body": "ok"}'), (1, 0, "a", "search", json.dumps({"limit": 3, "query": "q"}))]
    calls_df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, call_id string, name string, arguments string, level string")
    results = spark.createDataFrame([("a", "A"), ("b", None), ("d", "D"), ("q", "Q"), (None, "N"), ("a", "A")], "call_id string, content string")
    got = {r["call_id"]: r for r in tool_linking.link(calls_df.drop("level"), results).collect()}
    assert {i: r["status"] for i, r in got.items()} == {
        "a": "answered", "b": "answered", "c": "unanswered", "d": "answered", "e": "unordered", "f": "unordered", "g": "invalid",
        "h": "invalid", "i": "invalid", "j": "unordered", "k": "unordered", "l": "invalid", "m": "invalid", "n": "invalid",
        "o": "unanswered", "q": "orphan"}
    assert [(got[i]["level"], got[i]["position"]) for i in "abcd"] == [(0, 1), (1, 2), (2, 3), (0, 1)]
    assert got["g"]["errors"] == ["body is out of bounds", "unknown field more"]
    assert got["i"]["errors"] == ["limit is not a integer", "query is not a string"]
    for r in got.values():
        assert tool_linking.canonical(json.loads(r["message"])) == r["message"]
    assert json.loads(got["d"]["message"])["call"]["arguments"] == {"body": "y", "after": ref("c"), "urgent": True}
    assert tool_linking.link(calls_df.where("false"), results.where("false")).count() == 0


def plain_links(turns):
    """{(conv_id, call_id): (status, level, errors, message)} of (conv_id, turn, role, text) rows, one call at a time."""
    calls, results = {}, {}
    for conv, turn, role, text in turns:
        for k, line in enumerate((text or "").split("\n")):
            n, after = len(line), None
            if role == "assistant":
                results.setdefault((conv, f"call-{turn - 1}-{k}"), []).append(line)
                continue
            if n and n % 17 == 0:
                after = f"call-{turn}-{k + 1}"
            elif n and n % 19 == 0:
                after = f"call-{turn + 2}-{k}"
            elif n % 2 and k:
                after = f"call-{turn}-{k // 2}"
            tool = ("search", "lookup", "note")[n % 3]
            args = {0: {"query": line, "limit": n % 23}, 1: {"key": line}, 2: {"body": line, **({"urgent": n % 2 == 0} if n % 5 == 0 else {})}}[n % 3]
            calls[conv, f"call-{turn}-{k}"] = (turn, tool, {**args, **({"after": {"$result": after}} if after else {})})

    def level(key, above=()):
        if key in above:
            return None
        turn, _, args = calls[key]
        needs = args.get("after", {}).get("$result")
        if needs is None:
            return 0
        other = (key[0], needs)
        if other not in calls or calls[other][0] > turn:
            return None
        if calls[other][0] < turn:
            return 0
        under = level(other, (*above, key))
        return None if under is None else under + 1

    out = {}
    for key in calls.keys() | results.keys():
        answer = min(results[key]) if key in results else None
        message, errors, at = {"call_id": key[1]}, None, None
        if key in calls:
            _, tool, args = calls[key]
            errors, at = tool_linking.violations(tool, args), level(key)
            message["call"] = {"name": tool, "arguments": args}
        if answer is not None:
            message["result"] = {"role": "tool", "content": answer}
        status = "orphan" if errors is None else "invalid" if errors else "unordered" if at is None else (
            "unanswered" if answer is None else "answered")
        out[key] = (status, at, errors, json.dumps({**message, "status": status}, ensure_ascii=False, sort_keys=True, separators=(",", ":")))
    return out


def test_linking_of_given_conversations(spark):
    turns = [tuple(r) for r in table(spark, DATA, "conversations").select("conv_id", "turn", "role", "text").collect()]
    got = {(r["conv_id"], r["call_id"]): (r["status"], r["level"], r["errors"], r["message"]) for r in tool_linking.query(spark, DATA).collect()}
    assert got == plain_links(turns)
    assert {"answered", "orphan", "unordered"} <= {x[0] for x in got.values()}


def test_identifiers_belong_to_their_conversation(spark):
    kinds = "conv_id long, turn long, call_id string, name string, arguments string"
    ref = json.dumps({"body": "b", "after": {"$result": "call_2"}})
    calls = spark.createDataFrame([(1, 0, "call_1", "note", '{"body": "one"}'), (2, 0, "call_1", "note", '{"body": "two"}'),
                                   (None, 0, "call_1", "note", '{"body": "none"}'), (1, 0, "call_2", "note", '{"body": "x"}'),
                                   (2, 1, "call_3", "note", ref), (1, 1, "call_3", "note", ref)], kinds)
    results = spark.createDataFrame([(2, "call_1", "B"), (None, "call_1", "N"), (3, "call_1", "C")], "conv_id long, call_id string, content string")
    got = {(r["conv_id"], r["call_id"]): r for r in tool_linking.link(calls, results).collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        (1, "call_1"): "unanswered", (2, "call_1"): "answered", (None, "call_1"): "answered", (1, "call_2"): "unanswered",
        (2, "call_3"): "unordered", (1, "call_3"): "unanswered", (3, "call_1"): "orphan"}
    assert json.loads(got[2, "call_1"]["message"])["result"]["content"] == "B"


def test_hostile_arguments_are_reported(spark):
    hostile = ['{"body": "\\ud800"}', "[" * 100_000 + "]" * 100_000, "1" * 10_000, '{"body": "' + "x" * 3_000_000 + '"}', "", "nul"]
    calls = spark.createDataFrame([(1, 0, f"c{i}", "note", a) for i, a in enumerate(hostile)],
                                  "conv_id long, turn long, call_id string, name string, arguments string")
    none = spark.createDataFrame([], "conv_id long, call_id string, content string")
    got = {r["call_id"]: r["errors"] for r in tool_linking.link(calls, none).collect()}
    assert got == {"c0": ["arguments are not JSON"], "c1": ["arguments are not JSON"], "c2": ["arguments are not JSON"],
                   "c3": ["body is out of bounds"], "c4": ["arguments are not an object"], "c5": ["arguments are not JSON"]}


def test_quality_sees_every_chunk():
    draw = np.random.default_rng(1)
    texts = [draw.integers(0, 256, n).astype(np.uint8) for n in (0, 3, 5, 200, 260, 261, 5000)]
    flat, of, start, valid = quality_cnn.chunk_places(texts)
    model = quality_cnn.fit([], np.zeros(0), np.zeros(0, int))
    for i, t in enumerate(texts):
        padded = np.append(t, np.zeros(max(0, quality_cnn.WIDTH - len(t)), np.uint8))
        n, covered = len(padded) - quality_cnn.WIDTH + 1, set()
        logits = []
        for s, v in zip(start[of == i], valid[of == i]):
            data = flat[s:s + v + quality_cnn.WIDTH - 1]
            first = s - start[of == i][0]
            assert (data == padded[first:first + v + quality_cnn.WIDTH - 1]).all()
            covered.update(range(first, first + v))
            response = sum(model.tables[k][data[k:k + v]] for k in range(quality_cnn.WIDTH))
            logits.append(np.maximum(response.max(axis=0) + model.bias, 0) @ model.out + model.out_bias)
        assert covered == set(range(n))
        want = quality_cnn.summary(np.array(logits), len(t))
        assert np.allclose(model.features(t), want, atol=1e-5)
        assert model.probability(None if not len(t) else t.tobytes().decode("latin-1")) >= 0
    plain = 1 / (1 + np.exp(-quality_cnn.summary(np.array(logits), 5000) @ model.combine))
    assert 0 < plain < 1


def test_audit_of_large_ids_crowded_ids_and_swapped_pages(spark):
    schema = "page_id long, url string, html string"
    top = 2 ** 62 - 1
    rows = [(top - i, "u", h.prose(i, 9)) for i in range(40)] + [(7, f"u{i}", h.prose(i, 5)) for i in range(300)] + [
        (None, f"s{i}", "x") for i in range(60)] + [(100, "a", "one"), (101, "a", "two")]
    pages = spark.createDataFrame(rows, schema)
    swapped = {(100, "a", "one"): (100, "a", "two"), (101, "a", "two"): (101, "a", "one"), (7, "u5", h.prose(5, 5)): (7, "u5", "other")}
    other = spark.createDataFrame([swapped.get(r, r) for r in rows], schema)
    got = merkle_audit.audit(pages, other).collect()
    assert all(r["file_id"] == r["page_id"] // 4096 for r in got if r["page_id"] is not None)
    assert Counter(r["status"] for r in got) == Counter(corrupt=3, intact=len(rows) - 3)
    mine, theirs = (merkle_audit.tree(merkle_audit.records(x)) for x in (pages, other))
    bad = {r["node"] for r in merkle_audit.differing(mine, theirs).collect()}
    assert bad == {7, 100, 101}


def test_texts_without_letters_have_no_language(spark):
    docs = table(spark, DATA, "documents").select("doc_id", "text", "lang")
    odd = spark.createDataFrame([(-1, "½ ² 12 !", None), (-2, None, None), (-3, "… ③ %", None)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["lang_pred"] for r in language_kernel.predict(docs.unionByName(odd)).where("doc_id < 0").collect()}
    assert got == {-1: "und", -2: "und", -3: "und"}


@pytest.fixture(scope="module")
def stages(spark):
    import corpus_pipeline
    from barloom.llm.common import written
    docs, out = table(spark, "/root/testdata/sf0.001", "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = written(stage(spark, docs, "/root/testdata/sf0.001"), f"test-{name}")
        out.append((name, docs, after))
        docs = after
    return out


def test_pipeline_stages_do_what_their_operators_say(spark, stages):
    before = {name: [tuple(r) for r in a.select("doc_id", "text").collect()] for name, a, _ in stages}
    after = {name: {r["doc_id"]: r for r in b.collect()} for name, _, b in stages[:-1]}
    for name, a, b in stages[:-1]:
        assert b.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    letters = {i for i, t in before["language"] if any(c.isalpha() for c in t or "")}
    assert set(after["language"]) <= letters and len(after["language"]) > 0.97 * len(letters)
    want = {c for i, n, c in h.jaccard_components(before["near_duplicates"]) if n} | {i for i, t in before["near_duplicates"] if not h.shingles(t)}
    assert set(after["near_duplicates"]) == want
    import test_pairs_and_spans as brute
    items = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "benchmark").collect()]
    rules = {r[0]: r for r in brute.contaminated(before["benchmark_passages"], items)}
    texts = dict(before["benchmark_passages"])
    assert set(after["benchmark_passages"]) == {i for i, r in rules.items() if not r[5]}
    for i, r in after["benchmark_passages"].items():
        assert (r["text"] == texts[i]) == (rules[i][2] == 0) and r["n_chars"] == len(r["text"])
    texts = dict(before["personal_data"])
    assert set(after["personal_data"]) == set(texts)
    for i, r in after["personal_data"].items():
        assert not h.base_spans(r["text"]) or not h.base_spans(texts[i]) or h.base_spans(r["text"]) != h.base_spans(texts[i])
        assert bool(h.base_spans(texts[i])) <= (r["text"] != texts[i])
    pieces_fit(stages[-1][2].collect(), before["packed"])


def test_crc_of_pieces(spark):
    got = packing.query(spark, "/root/testdata/sf0.001").where("start = 0 AND length = doc_tokens").limit(20).collect()
    docs = {r["doc_id"]: r["text"] for r in table(spark, "/root/testdata/sf0.001", "documents").collect()}
    assert got and all(r["ids_crc32"] == zlib.crc32(packing.token_ids(docs[r["doc_id"]]).tobytes()) for r in got)
