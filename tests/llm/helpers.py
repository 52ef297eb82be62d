"""Small frames with every awkward case, and plain-Python versions of the operators' rules."""

import re

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(n, seed):
    vocab = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(vocab[(x >> 8) % len(vocab)] + str((x >> 16) % 37))
    return " ".join(out)


BASE = sentence(120, 1)
AWKWARD = [
    (1, BASE), (2, BASE), (2, BASE), (3, None), (4, ""), (5, " \t\n "), (6, "one"), (7, "Four Words Only Here"),
    (8, BASE.upper()), (9, BASE.replace("alpha", "ALPHA", 1)), (10, sentence(120, 2)), (11, sentence(119, 2) + " changed"),
    (None, sentence(80, 3)), (13, "é日本 " * 300 + BASE), (14, sentence(6000, 5)), (15, "a\x00b " + BASE[:250]), (16, "x" * 900),
    (17, sentence(40, 6) + "\n" + sentence(40, 6) + "\n\n" + sentence(40, 6)), (18, "one"),
]


def frame(spark, rows=AWKWARD):
    """The rows as a documents table with clashing extra columns."""
    full = [(i, t, "en", "src", None, "x", -1, "k") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA + ", node string, kept int, g string").repartition(3)


def collect(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)
