"""Rows that operators on text must stand, and plain Python versions of what they compute."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"
LONG = " ".join(f"wort{i % 5003}" for i in range(60_000))

SCHEMA = """doc_id long, text string, lang string, source string, n_chars long, score string, kept string, size string,
    target string, copies string, taken string, fingerprint string, component_id string, n_words string, n_lines string,
    lang_pred string, licenses string, `odd name.x` string, __llm_k string"""

TEXTS = [
    None, "", "   ", "\n", "\n\n \t\n", "a", "One two", "one TWO", "ÀÉ é ß", "one two three four", "One two three four five six",
    "Same line\nother", " same LINE \nthird", "x\x0bSame line\x0c\ny", "!!! ??? 123", "一 二 三 四 五", "a a a a a a a", "\x1f\x1ca\x85b",
    "The quick brown fox jumps over the lazy dog near the river bank today.", LONG, "Same line"]


def documents(spark, times: int = 1):
    """Odd texts, with null ids, sources and labels, repeated rows and repeated ids, and columns of all names the operators use."""
    rows = []
    for n in range(times):
        for i, text in enumerate(TEXTS):
            rows.append((n * 1000 + i, text, [None, "en", "de"][i % 3], [None, "b", "a", "é"][i % 4], i))
    rows += [(None, "no id", "en", "a", 1), (None, "no id", "en", "a", 1), (5, "a", None, None, None), (5, "other", "en", "b", 2),
             (None, None, None, None, None)]
    return spark.createDataFrame([(*r, *["taken"] * 13, "own") for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def given(spark, name: str, sf: str = SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def size_of(text: str | None) -> int:
    return len(WORD.findall(text or ""))


def components(items, near) -> dict:
    """The smallest key reachable over links; items: key -> value."""
    keys = sorted(items)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if near(items[a], items[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in keys}


def without_shared_lines(texts, least: int) -> list[tuple[int, int, str]]:
    def key(line):
        return re.sub(r"[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    split = [(t or "").split("\n") for t in texts]
    shared = Counter(k for lines in split for k in {key(x) for x in lines} if k)
    out = []
    for lines in split:
        kept = [x for x in lines if not key(x) or shared[key(x)] < least]
        out.append((len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def python_nodes(df) -> list[str]:
    """Python operators in a plan."""
    return re.findall(r"\w*(?:Python|Pandas|Arrow)\w*", df._jdf.queryExecution().executedPlan().toString())
