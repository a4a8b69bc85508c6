"""Small tables with every odd case, and plain Python forms of the contracts."""

import re
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long, point long, content long, `drop` string, `all` string, row string"
WORDS = ("alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec "
         "romeo sierra tango uniform victor whiskey xray yankee zulu").split()


def prose(seed: int, n: int) -> str:
    """``n`` words that depend on ``seed``."""
    out, x = [], seed * 2654435761 % 2 ** 32 + 1
    for _ in range(n):
        x = (1103515245 * x + 12345) % 2 ** 31
        out.append(WORDS[(x >> 16) % len(WORDS)] + str((x >> 8) % 50))
    return " ".join(out)


def odd_rows():
    """NULLs in every column, empty and blank texts, a very long text, repeated rows, ties, non-ASCII."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "changed"
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, prose(2, 80)), (5, None), (6, ""), (7, " \n\t "), (8, "one"),
        (9, "Éa ÀB ñ Ωmega one two"), (10, prose(3, 30000)), (11, "A b C d"), (12, "a B c D"), (None, base), (None, None),
        (13, prose(4, 5)), (13, prose(5, 60)), (14, prose(6, 70)), (14, prose(6, 70)), (15, "x" * 50000), (16, "1 2 3!? ... %%%"),
    ]
    return [(i, t, None if i in (2, 9) else "en", None if i == 4 else f"s{n}", None if t is None else len(t), n, -n, "d", None, "r")
            for n, (i, t) in enumerate(texts)]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def remainder(doc_id, parts):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", lower(text)) if x]
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def jaccard_components(rows):
    """[(doc_id, n_shingles, component_id)] of (doc_id, text) rows by comparing every pair."""
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                group[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        g = find(i)
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    """[(kind, start, end)] by the contract's patterns, in order."""
    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
    }
    out = [(m.start(), rank, m.end(), kind) for rank, (kind, (pattern, fits)) in enumerate(kinds.items())
           for m in re.finditer(pattern, text or "") if fits(m[0])]
    return [(kind, start, end) for start, _, end, kind in sorted(out)]
