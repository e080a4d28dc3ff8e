"""Plain counterparts of what the operators compute, and rows with every odd value."""

import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, set_id long, c0 string"


def words(text, lower=True):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def prose(seed, n, vocabulary=400):
    """n pseudo-random words."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("w" + "abcdefghij"[x % 10] + "klmnopqrst"[x // 10 % 10] + str(x // 100 % vocabulary))
    return out


def lettered(seed, n):
    """n pseudo-random words without digits."""
    out, x = [], seed * 7919 + 17
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append("".join("abcdefghijklmnop"[x >> s & 15] for s in (4, 9, 14, 19, 24)))
    return out


def odd_rows():
    """Nulls in every column, empty and long texts, repeated rows, equal ids with other texts."""
    long_text = " ".join(lettered(1, 60_000))
    plain = " ".join(lettered(2, 40))
    return [
        (1, plain, "en", "a", 5, 1, True, 9, "x"),
        (1, plain, "en", "a", 5, 1, True, 9, "x"),
        (2, None, None, None, None, None, None, None, None),
        (3, "", "en", "a", 0, 1, True, 9, "x"),
        (4, " \n\t ", "de", "b", 0, 1, True, 9, "x"),
        (5, long_text, "en", "a", 1, 1, True, 9, "x"),
        (None, plain + " more", "fr", "b", 1, None, None, None, None),
        (6, "short", "fr", None, 1, 1, False, 9, "x"),
        (7, plain, None, "b", 1, 1, False, 9, "x"),
        (8, "\n".join([plain, "", plain]), "en", "c", 1, 1, False, 9, "x"),
        (8, "other text of the same id", "en", "c", 1, 1, False, 9, "x"),
        (9, "ünï çödé ÄÖ 漢字 🙂 " + plain, "de", "c", 1, 1, False, 9, "x"),
    ]


def odd_docs(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
