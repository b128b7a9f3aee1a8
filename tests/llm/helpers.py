"""Small tables with awkward rows, and plain versions of what the operators compute."""

import re
import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TABLE = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return (text or "").encode().translate(TABLE).split()


def sentence(seed, n=40):
    return " ".join(f"w{(seed * 7919 + i * 104729 + i * i * seed) % 997}x" for i in range(n)) + "."


def awkward(spark):
    """Nulls everywhere, empty and blank texts, one long text, copies, near copies, repeated rows, other scripts."""
    long = " ".join(sentence(i, 50) for i in range(400))
    near = sentence(5, 60)
    rows = [
        (1, sentence(1), "en", "a", 1), (2, sentence(1), "en", "b", 1), (3, None, None, None, None), (4, "", "en", "a", 0),
        (5, " \t\n ", "en", "c", 4), (6, long, "en", "a", 5), (7, near, "de", "b", 6), (8, near + " more", "de", "b", 6),
        (9, "one two", "en", None, 7), (10, "one two", "en", "a", 7), (11, "ÄÖ üß 漢字 😀 a@b.cd +49 151 2345678 10.0.0.1 4111 1111 1111 1111", "de", "d", 9),
        (12, sentence(12), "en", "a", 3), (12, sentence(12), "en", "a", 3), (13, "x" * 5000, "en", "e", 5000), (14, "0" * 6000, "en", "e", 6000),
        (15, "a." * 3000 + "@x" + ".y" * 3000, "en", "e", 0),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    """The table with further columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    for name in ("score", "keep", "size", "shard", "slot", "mark", "spans", "row", "_slice", "_weight", "before", "total", "bucket", "id", "s", "doc"):
        df = df.withColumn(name, F.lit("x"))
    return df


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(rows):
    """doc_id -> least doc_id reachable, comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (a, s) in enumerate(sets):
        for b, t in sets[:n]:
            if s and t and 100 * len(s & t) >= 80 * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in sets}


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text):
    text, out = text or "", []
    for rank, (kind, pattern) in enumerate((("email", EMAIL), ("ip", IP), ("card", CARD), ("phone", PHONE))):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda: True, "ip": lambda: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if good:
                out.append((m.start(), rank, kind, m.end()))
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(out))
