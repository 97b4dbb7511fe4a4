"""Operator 5: license scan by ordered signature rules (DataFrame functions only).

A text becomes its normal form: words of ASCII letters, digits and
non-ASCII characters, A-Z lower-cased, one blank before, between and after.
Rules are regular expressions over that form, each with a keyword that must
occur for the rule to run, a label, a priority and a confidence.  Texts
without a word that some rule needs are not normalised at all.

Every match is a detection with its word interval.  A detection inside
another one of the same or higher priority is suppressed, in one pass over
the detections sorted by start and falling end.  The three base phrases are
found the same way and always stay.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import whole_text

_NOT_WORD = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
WORD = f"[^{_NOT_WORD}]++"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases whose places are counted, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Licence names in normal form, with the words that gate them.
# label, keyword, pattern of the name
NAMES = [
    ("apache-1.1", "apache", r"apache (?:software )?licen[cs]e (?:version |v ?)?1 1"),
    ("apache-2.0", "apache", r"apache (?:software )?licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e"),
    ("mit", "mit", r"mit licen[cs]e"),
    ("mit", "expat", r"expat licen[cs]e"),
    ("mit-0", "mit", r"mit (?:no attribution|0) licen[cs]e"),
    ("x11", "x11", r"(?:mit )?x11 licen[cs]e"),
    ("isc", "isc", r"isc licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|(?:new|revised|modified) bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: licen[cs]e)?"),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd)(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e"),
    ("gpl-1.0", "public", r"(?:gnu )?general public licen[cs]e (?:version |v ?)1(?: 0)?"),
    ("gpl-2.0", "public", r"(?:gnu )?general public licen[cs]e (?:version |v ?)2(?: 0)?"),
    ("gpl-3.0", "public", r"(?:gnu )?general public licen[cs]e (?:version |v ?)3(?: 0)?"),
    ("gpl", "public", r"(?:gnu )?general public licen[cs]e"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl ?v? ?2(?: 0)?"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl ?v? ?3(?: 0)?"),
    ("gpl", "gpl", r"gnu gpl(?: licen[cs]e)?"),
    ("lgpl-2.1", "public", r"(?:gnu )?(?:lesser|library) general public licen[cs]e (?:version |v ?)2 1"),
    ("lgpl-3.0", "public", r"(?:gnu )?(?:lesser|library) general public licen[cs]e (?:version |v ?)3(?: 0)?"),
    ("lgpl", "public", r"(?:gnu )?(?:lesser|library) general public licen[cs]e"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl(?: ?v? ?[23](?: [01])?)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[cs]e(?: (?:version |v ?)3(?: 0)?)?"),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl(?: ?v? ?3(?: 0)?)?"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation licen[cs]e(?: (?:version |v ?)1 [123])?"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e (?:version |v ?)?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e (?:version |v ?)?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("epl", "eclipse", r"eclipse public licen[cs]e"),
    ("edl", "eclipse", r"eclipse distribution licen[cs]e"),
    ("cddl", "distribution", r"common development and distribution licen[cs]e"),
    ("cpl", "common", r"common public licen[cs]e"),
    ("eupl", "european", r"european union public licen[cs]e"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e (?:version |v ?)?2(?: 0)?"),
    ("artistic", "artistic", r"artistic licen[cs]e"),
    ("psf", "python", r"python (?:software foundation )?licen[cs]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("boost", "boost", r"boost software licen[cs]e(?: (?:version )?1(?: 0)?)?"),
    ("unlicense", "unlicen", r"(?:the )?unlicen[cs]e"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("ofl", "font", r"(?:sil )?open font licen[cs]e"),
    ("odbl", "database", r"open database licen[cs]e"),
    ("odc-by", "commons", r"open data commons attribution licen[cs]e"),
    ("pddl", "domain", r"public domain dedication and licen[cs]e"),
    ("openrail", "rail", r"(?:creativeml )?open ?rail(?: m| s)? licen[cs]e"),
    ("openrail", "rail", r"(?:creativeml )?open ?rail (?:m|s)"),
    ("bigcode-openrail", "bigcode", r"bigcode open ?rail m"),
    ("mulan", "mulan", r"mulan (?:psl|permissive software licen[cs]e)"),
    ("ms-pl", "microsoft", r"microsoft (?:public|reciprocal) licen[cs]e"),
    ("cc0", "cc0", r"cc0(?: 1 0)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s"),
    ("cc-by-nc-sa", "commons", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", "commons", r"creative commons attribution non ?commercial"),
    ("cc-by-nd", "commons", r"creative commons attribution no ?deriv(?:ative)?s"),
    ("cc-by-sa", "commons", r"creative commons attribution share ?alike"),
    ("cc-by", "commons", r"creative commons attribution"),
    ("cc0", "commons", r"creative commons (?:zero|cc0)"),
    ("cc", "commons", r"creative commons"),
]
# Statements in normal form.  label, keyword, pattern, priority, confidence
STATEMENTS = [
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy", 3, 0.95),
    ("isc", "distribute", r"permission to use copy modify and or distribute this software for any purpose", 3, 0.95),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification", 3, 0.95),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", 3, 0.95),
    ("zlib", "altered", r"altered source versions must be plainly marked as such", 3, 0.9),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 3, 0.95),
    ("warranty-disclaimer", "warrant", r"(?:provided as is )?without (?:any )?warrant(?:y|ies) (?:of any kind|or conditions)", 1, 0.4),
    ("warranty-disclaimer", "warrant", r"without even the implied warranty of merchantability", 1, 0.4),
    ("public-domain", "domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain", 2, 0.8),
    ("public-domain", "domain", r"(?:is|are) in the public domain", 2, 0.7),
    ("public-domain", "domain", r"public domain", 1, 0.4),
    ("no-copyright", "copyright", r"no (?:known )?copyright(?: restrictions)?", 2, 0.6),
    ("copyright", "copyright", r"copyright (?:c )?(?:19|20)\d\d(?: (?:19|20)\d\d)?", 1, 0.4),
    ("copyright", "copyright", r"copyright (?:c )?(?:by )?[^ ]+", 1, 0.3),
    ("copyleft", "copyleft", r"copyleft", 1, 0.3),
    ("reserved", "reserved", r"(?:all|some|no) rights (?:are )?reserved", 1, 0.5),
    ("proprietary", "licen", r"proprietary licen[cs]e", 2, 0.7),
    ("commercial", "licen", r"commercial licen[cs]e", 2, 0.6),
    ("proprietary", "permission", r"may not be (?:reproduced|copied|redistributed|reprinted)[^ ]*(?: [^ ]+){0,8} without (?:prior )?(?:written )?permission", 2, 0.7),
    ("non-commercial", "commercial", r"for non ?commercial (?:use|purposes) only", 2, 0.6),
    ("non-commercial", "research", r"for research (?:use|purposes) only", 2, 0.6),
    ("non-commercial", "academic", r"for academic (?:use|purposes) only", 2, 0.6),
    ("dual", "licen", r"dual licen[cs]ed", 2, 0.5),
    ("unspecified", "licen", r"licen[cs]ed under", 1, 0.3),
    ("unspecified", "licen", r"licen[cs]e (?:agreement|terms)", 1, 0.3),
    ("eula", "licen", r"end user licen[cs]e agreement", 2, 0.7),
]
_GRANT = (r"(?:licen[cs]ed|released|distributed|published|available|provided|shared|covered) "
          r"(?:under|by|subject to) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?(?:an? )?")


def rules() -> list[tuple[str, str, str, int, float]]:
    """``label, keyword, pattern, priority, confidence``: each name alone, granted, cited and as identifier."""
    out = list(STATEMENTS)
    for label, keyword, name in NAMES:
        out.append((label, keyword, name, 2, 0.7))
        out.append((label, keyword, _GRANT + f"(?:{name})", 3, 1.0))
        out.append((label, keyword, rf"(?:see|read) the (?:{name})", 2, 0.6))
    for label in dict.fromkeys(n[0] for n in NAMES):
        words = " ".join(re.findall(r"[0-9a-z]+", label))
        out.append((label, "spdx", rf"spdx licen[cs]e identifier {words}(?: only| or later)?", 4, 1.0))
    return out


def triggers() -> list[str]:
    """Words one of which every text with a detection has, but for "cc by": of each rule its keyword, or "licen" if it needs that.

    Grants and citations hold a name; so do they hold the name's word.
    """
    words = {"spdx", "licen", "reserved"}  # the last two: of the base phrases
    for keyword, pattern in [(n[1], n[2]) for n in NAMES] + [(s[1], s[2]) for s in STATEMENTS]:
        needed, before = pattern, ""
        while needed != before:  # without groups, which may be optional or alternatives
            needed, before = re.sub(r"\(\?:[^()]*\)(?:[?]|\{[^}]*\})?", "", needed), needed
        if not pattern.startswith("cc by"):
            words.add("licen" if "licen" in needed else keyword)
    return sorted(w for w in words if not any(v != w and v in w for v in words))


#: Characters that no normal form holds, put around matches.
_OPEN, _CLOSE = "\x01", "\x02"


def _places(words: Column, mark: str, at_start: bool) -> Column:
    """Numbers of the words that begin or end with a mark (the first element is what stands before the first space)."""
    def place(word: Column, i: Column) -> Column:
        return F.when(word.startswith(mark) if at_start else word.endswith(mark), i - 1)

    return F.filter(F.transform(words, place), lambda i: i.isNotNull())


def _intervals(norm: Column, pattern: Column) -> Column:
    """Word intervals ``struct<start, stop>`` of the matches of a pattern.

    Matches are marked in the text and their words found by number, so the
    cost grows with the text and not with matches times matches.
    """
    marked = F.regexp_replace(norm, pattern, F.lit(f"{_OPEN}$0{_CLOSE}"))
    pairs = _let(F.split(marked, " "), lambda words: F.arrays_zip(
        _places(words, _OPEN, True).alias("start"), _places(words, _CLOSE, False).alias("last")))
    intervals = F.transform(pairs, lambda x: F.struct(x["start"].alias("start"), (x["last"] + 1).alias("stop")))
    return F.when(F.rlike(norm, pattern), intervals).otherwise(F.array().cast("array<struct<start:int,stop:int>>"))


def _labelled(intervals: Column, label: str) -> Column:
    return F.transform(intervals, lambda x: F.struct(
        F.lit(label).alias("label"), x["start"].alias("start"), x["stop"].alias("stop")))


def _bounded(pattern: str) -> str:
    return f"(?<= )(?:{pattern})(?= )"


def _triggered(low: Column, text: Column) -> Column:
    out = low.contains("cc") & text.rlike(rf"(?i)cc[{_NOT_WORD}]+by")
    for word in triggers():
        out = low.contains(word) | out
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, base, detections, kept`` of every row.

    ``base``: label and word interval of every place of a base phrase.
    ``detections``: label, priority, confidence and word interval of every
    rule match; ``kept``: those not suppressed.  Null and empty texts have
    no words and empty lists.  Every row gives one row; other columns are
    left out.
    """
    text = whole_text(text_col)
    counted = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id", "t", F.regexp_count("t", F.lit(WORD)).cast("long").alias("n_words"), F.lower("t").alias("low"))
    gated = counted.select("id", "n_words", F.when(_triggered(F.col("low"), F.col("t")), F.col("t")).alias("t"))
    words = F.translate(F.array_join(F.regexp_extract_all("t", F.lit(f"({WORD})"), F.lit(1)), " "), _UPPER, _LOWER)
    normal = gated.select("id", "n_words", F.concat(F.lit(" "), words, F.lit(" ")).alias("norm"))
    kinds = "struct<label:string,priority:int,confidence:double,start:int,stop:int>"
    table = F.array(*[F.struct(
        F.lit(label).alias("label"), F.lit(keyword).alias("keyword"), F.lit(_bounded(pattern)).alias("pattern"),
        F.lit(priority).alias("priority"), F.lit(confidence).alias("confidence"))
        for label, keyword, pattern, priority, confidence in rules()])
    norm = F.col("norm")
    base = F.flatten(F.array(*[_labelled(_intervals(norm, F.lit(_bounded(p))), label) for p, label in BASE.items()]))
    found = F.flatten(F.transform(
        F.filter(table, lambda r: norm.contains(r["keyword"])),
        lambda r: F.transform(_intervals(norm, r["pattern"]), lambda x: F.struct(
            r["label"].alias("label"), r["priority"].alias("priority"), r["confidence"].alias("confidence"),
            x["start"].alias("start"), x["stop"].alias("stop")))))
    none = F.array()
    listed = normal.select(
        "id", "n_words",
        F.coalesce(F.when(norm.isNotNull(), base), none.cast("array<struct<label:string,start:int,stop:int>>")).alias("base"),
        F.coalesce(F.when(norm.isNotNull(), found), none.cast(f"array<{kinds}>")).alias("detections"))
    return _with_kept(listed, kinds).withColumnRenamed("id", id_col)


#: Priorities go from 1 to TOP; detections are compared in blocks of so many.
TOP, BLOCK = 4, 128


def _with_kept(listed: DataFrame, kinds: str) -> DataFrame:
    """Add ``kept``: detections not inside another one of the same or higher priority.

    In order of start (longer and more important ones first) a detection is
    inside if one before it, of its priority or more, reaches its end.  How
    far those before reach is taken from the ends of whole blocks and, within
    a block, from the few before, so the cost grows with the detections.
    """
    def reach(items: Column, priority: Column) -> Column:
        ends = F.transform(items, lambda d: F.when(d["priority"] >= priority, d["stop"]))
        return F.coalesce(F.array_max(ends), F.lit(-1))

    def kept_of(detections: Column, numbers: Column) -> Column:
        def block(b: Column) -> Column:
            return F.slice(detections, b * BLOCK + 1, F.lit(BLOCK))

        def outside(items: Column, before: Column) -> Column:
            marked = F.transform(items, lambda d, i: F.struct(d.alias("d"), (F.greatest(
                F.element_at(before, d["priority"]), reach(F.slice(items, F.lit(1), i), d["priority"])) < d["stop"]).alias("keep")))
            return F.transform(F.filter(marked, lambda x: x["keep"]), lambda x: x["d"])

        def furthest(ends: Column, b: Column) -> Column:
            return _let(F.slice(ends, F.lit(1), b), lambda done: F.array(*[
                F.coalesce(F.array_max(F.transform(done, lambda e: e[p])), F.lit(-1)) for p in range(TOP)]))

        ends = F.transform(numbers, lambda b: _let(block(b), lambda items: F.array(
            *[reach(items, F.lit(p)) for p in range(1, TOP + 1)])))
        return _let(ends, lambda e: F.flatten(F.transform(numbers, lambda b: _let(
            block(b), lambda items: _let(furthest(e, b), lambda before: outside(items, before))))))

    ordered = F.transform(F.array_sort(F.transform("detections", lambda d: F.struct(
        d["start"].alias("start"), (-d["stop"]).alias("before"), (-d["priority"]).alias("rank"), d.alias("d")))),
        lambda x: x["d"])
    kept = _let(ordered, lambda o: _let(
        F.sequence(F.lit(0), F.floor((F.size(o) - 1) / BLOCK).cast("int")), lambda numbers: kept_of(o, numbers)))
    none = F.array().cast(f"array<{kinds}>")
    return listed.withColumn("kept", F.when(F.size("detections") > 0, kept).otherwise(none))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, places, labels and score of the result of ``scan``."""
    def labels(*columns: Column) -> Column:
        names = F.concat(*[F.transform(c, lambda x: x["label"]) for c in columns])
        return F.array_join(F.array_sort(F.array_distinct(names)), ",")

    starts = F.transform("base", lambda x: x["start"].cast("long"))
    return scanned.select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(F.col("base")).alias("base_labels"), labels(F.col("base"), F.col("kept")).alias("labels"),
        F.coalesce(F.greatest(
            F.array_max(F.transform("kept", lambda x: x["confidence"])),
            F.when(F.size("base") > 0, F.lit(0.5))), F.lit(0.0)).alias("score"))
