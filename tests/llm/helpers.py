"""Small document tables with the hard cases: nulls, empty and long texts, repeated rows, columns with clashing names."""

import random
import zlib

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = {"row": "7", "size": "1", "kept": "false", "score": "0.5", "n": "2", "key": "'k'", "label": "9", "token": "'t'", "sig": "'s'", "pattern": "3", "target": "1.5"}


def docs(spark, rows, clashing=True):
    full = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.selectExpr("*", *[f"{v} as {k}" for k, v in CLASHES.items()]) if clashing else df


def words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghij") for _ in range(2 + (r.randrange(vocabulary) % 7))) for _ in range(n))


def corpus(n=60, seed=1):
    """Documents of four sources and a null one; some repeat, some are nearly equal, some are empty or null."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        text = words(r.randrange(3, 160), seed * 1000 + i)
        if i % 9 == 4:
            text = out[-1][1]
        elif i % 9 == 5 and out[-2][1]:
            text = out[-2][1].upper() if i % 2 else out[-2][1] + " tail"
        elif i % 11 == 7:
            text = [None, "", " \t\n ", "one", "!!! ### $$$"][i % 5]
        out.append((i, text, ["en", "de", "fr", "es", None][i % 5], ["b", "a", "é", "Z", None][(i * 7) % 5]))
    out += [out[3], out[3], (None, "no id at all here", None, None), (None, None, None, None), (10**12, "tiny", "xx", "a")]
    out.append((500, words(30000, 77), "en", "b"))
    return out


def crc(i):
    return zlib.crc32(b"" if i is None else str(i).encode())
