"""License scan by ordered signature rules, as built-in Spark functions only.

A text is lower-cased and brought to words between single blanks.  A keyword
test on the whole text admits few documents; in these, each rule whose own
keyword occurs runs its regular expression.  A detection is dropped if one of
higher priority, or of the same priority and longer, covers its interval.

The rules are signatures of known licenses: tags, statements ("released under
the ..."), names with a version, and names alone, in falling priority.  Four
base phrases are always reported, suppressed or not.

Edge cases: a null, empty or wordless text has no words, no labels and score
0; repeated rows are scanned row by row.  Input columns named like the new
ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii, without

COLUMNS = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]

# The base phrases and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Label, name in words, short tag in words, and a keyword that every form of the name has.
LICENSES = [
    ("agpl", "gnu affero general public license", "agpl", "affero"),
    ("lgpl", "gnu (?:lesser|library) general public license", "lgpl", "general public"),
    ("gpl", "gnu general public license", "gpl", "general public"),
    ("gfdl", "gnu free documentation license", "gfdl", "free documentation"),
    ("apache", "apache (?:software )?license", "apache", "apache"),
    ("mit", "mit license", "mit", "mit"),
    ("mit-0", "mit no attribution license", "mit 0", "mit"),
    ("bsd-2-clause", "(?:bsd 2 clause|simplified bsd|freebsd) license", "bsd 2 clause", "bsd"),
    ("bsd-3-clause", "(?:bsd 3 clause|new bsd|revised bsd|modified bsd) license", "bsd 3 clause", "bsd"),
    ("bsd-4-clause", "(?:bsd 4 clause|original bsd|old bsd) license", "bsd 4 clause", "bsd"),
    ("0bsd", "zero clause bsd license", "0bsd", "bsd"),
    ("bsd", "bsd (?:style )?license", "bsd", "bsd"),
    ("mpl", "mozilla public license", "mpl", "mozilla"),
    ("epl", "eclipse public license", "epl", "eclipse"),
    ("edl", "eclipse distribution license", "edl", "eclipse"),
    ("eupl", "european union public licen[cs]e", "eupl", "european union"),
    ("cddl", "common development and distribution license", "cddl", "common development"),
    ("cpl", "common public license", "cpl", "common public"),
    ("cecill", "cecill (?:free software )?license(?: agreement)?", "cecill", "cecill"),
    ("artistic", "artistic license", "artistic", "artistic"),
    ("boost", "boost software license", "bsl", "boost"),
    ("busl", "business source license", "busl", "business source"),
    ("isc", "isc license", "isc", "isc"),
    ("zlib", "zlib (?:libpng )?license", "zlib", "zlib"),
    ("libpng", "libpng license", "libpng", "libpng"),
    ("unlicense", "(?:the )?unlicense", "unlicense", "unlicense"),
    ("wtfpl", "do what the fuck you want to public license", "wtfpl", "public license"),
    ("ofl", "sil open font license", "ofl", "open font"),
    ("postgresql", "postgresql license", "postgresql", "postgresql"),
    ("python", "python software foundation license", "psf", "python software"),
    ("php", "php license", "php", "php"),
    ("ruby", "ruby license", "ruby", "ruby"),
    ("openssl", "openssl license", "openssl", "openssl"),
    ("vim", "vim license", "vim", "vim"),
    ("x11", "x11 license", "x11", "x11"),
    ("ncsa", "(?:university of illinois )?ncsa open source license", "ncsa", "ncsa"),
    ("academic", "academic free license", "afl", "academic free"),
    ("osl", "open software license", "osl", "open software"),
    ("ms-pl", "microsoft public license", "ms pl", "microsoft"),
    ("ms-rl", "microsoft reciprocal license", "ms rl", "microsoft"),
    ("ibm", "ibm public license", "ipl", "ibm"),
    ("intel", "intel open source license", "intel", "intel"),
    ("lucent", "lucent public license", "lpl", "lucent"),
    ("qpl", "q public license", "qpl", "q public"),
    ("sleepycat", "sleepycat license", "sleepycat", "sleepycat"),
    ("sspl", "server side public license", "sspl", "server side"),
    ("elastic", "elastic license", "elastic", "elastic"),
    ("upl", "universal permissive license", "upl", "universal permissive"),
    ("mulan", "mulan (?:permissive|public) (?:software )?license", "mulanpsl", "mulan"),
    ("beerware", "beerware license", "beerware", "beerware"),
    ("fair", "fair license", "fair", "fair"),
    ("odbl", "open data commons open database license", "odbl", "open data commons"),
    ("odc-by", "open data commons attribution license", "odc by", "open data commons"),
    ("pddl", "open data commons public domain dedication and license", "pddl", "open data commons"),
    ("openrail", "(?:bigscience )?open ?rail(?: m)? license", "openrail", "rail"),
    ("llama", "llama \\d+ community license", "llama", "llama"),
    ("gemma", "gemma terms of use", "gemma", "gemma"),
    ("cc0", "creative commons zero", "cc0", "creative commons"),
    ("cc0", "cc ?0", "cc0", "cc"),
    ("cc-by-nc-nd", "creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: license)?", "cc by nc nd", "creative commons"),
    ("cc-by-nc-nd", "cc by nc nd(?: license)?", "cc by nc nd", "cc by"),
    ("cc-by-nc-sa", "creative commons attribution non ?commercial share ?alike(?: license)?", "cc by nc sa", "creative commons"),
    ("cc-by-nc-sa", "cc by nc sa(?: license)?", "cc by nc sa", "cc by"),
    ("cc-by-nc", "creative commons attribution non ?commercial(?: license)?", "cc by nc", "creative commons"),
    ("cc-by-nc", "cc by nc(?: license)?", "cc by nc", "cc by"),
    ("cc-by-nd", "creative commons attribution no ?deriv(?:ative)?s(?: license)?", "cc by nd", "creative commons"),
    ("cc-by-nd", "cc by nd(?: license)?", "cc by nd", "cc by"),
    ("cc-by-sa", "creative commons attribution share ?alike(?: license)?", "cc by sa", "creative commons"),
    ("cc-by-sa", "cc by sa(?: license)?", "cc by sa", "cc by"),
    ("cc-by", "creative commons attribution(?: license)?", "cc by", "creative commons"),
    ("cc-by", "cc by(?: license)?", "cc by", "cc by"),
]

VERSION = r"(?: version| v)?(?: \d+){1,2}"

# Label, keyword, expression, priority, score; not tied to one license.
GENERAL = [
    ("all-rights-reserved", "reserved", "all rights reserved", 2, 0.7),
    ("copyright", "copyright", r"copyright(?: c)? \d{4}", 2, 0.5),
    ("public-domain", "public domain", "(?:released into|dedicated to|placed in|in) the public domain", 3, 0.8),
    ("proprietary", "proprietary", "proprietary and confidential", 3, 0.8),
    ("royalty-free", "royalty", "royalty free", 1, 0.3),
    ("permission-grant", "permission", "permission is hereby granted free of charge", 3, 0.9),
    ("permission-grant", "permission", "permission to use copy modify and or distribute this software", 3, 0.9),
    ("warranty-disclaimer", "warranty", "without warranty of any kind", 2, 0.4),
    ("redistribution", "redistribution", "redistribution and use in source and binary forms", 3, 0.9),
    ("eula", "end user", "end user license agreement", 2, 0.7),
]

#: A text without any of these has no detection.
GATE = ("licen|copyright|spdx|cc ?by|cc ?0|creative commons|public domain|reserved|proprietary|royalty|permission|warranty|redistribution|gemma terms|wtfpl")


def rules() -> list[tuple[str, str, str, int, float]]:
    """Label, keyword, expression, priority and score of every rule, in order."""
    out = []
    for label, name, tag, keyword in LICENSES:
        out += [
            (label, "spdx", rf"spdx license identifier {tag}(?: \d+){{0,2}}(?: (?:only|or later))?", 4, 1.0),
            (label, "under", rf"(?:licensed|released|distributed|available|published|provided|shared|covered) under (?:the )?(?:terms of (?:the )?)?{name}(?:{VERSION})?", 3, 0.95),
            (label, keyword, rf"{name}{VERSION}(?: (?:only|or later))?", 2, 0.8),
            (label, keyword, name, 1, 0.6),
        ]
    return out + list(GENERAL)


def _words_text(text: Column) -> Column:
    """The words of a text, each after a blank, and a blank at the end."""
    inner = F.trim(F.regexp_replace(lower_ascii(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(inner == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), inner, F.lit(" ")))


def _blanks(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("long")


def scan(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``n_words``; of the base phrases ``n_base`` (places),
    ``first_word``, ``last_word``, ``base_labels``; ``labels`` (arrays, sorted),
    ``score``, and ``detections`` that stand (label, rule, character interval
    in the text of words, priority, score)."""
    table = F.array(*[F.struct(F.lit(i).alias("rule"), F.lit(a).alias("label"), F.lit(k).alias("keyword"), F.lit(f"(?<= )(?:{p})(?= )").alias("pattern"), F.lit(n).alias("priority"), F.lit(s).alias("score")) for i, (a, k, p, n, s) in enumerate(rules())])
    places = "(?<= )(?=(?:" + "|".join(p for p, _ in BASE) + ") )"
    nothing = "array<struct<rule:int,label:string,start:int,stop:int,priority:int,score:double>>"
    df = without(docs, [*COLUMNS, "_w", "_base", "_hits"]).withColumn("_w", _words_text(F.col("text")))
    df = df.withColumns({
        "n_words": F.greatest(_blanks(F.col("_w")) - 1, F.lit(0)),
        "_base": F.when(F.col("_w").rlike("licen|cc by"), F.split("_w", places, -1)).otherwise(F.array("_w")),
        "_hits": F.when(F.col("_w").rlike(GATE), _detections(table)).otherwise(F.array().cast(nothing)),
    })
    base = F.filter(F.array(*[F.struct(F.lit(f" {p} ").alias("p"), F.lit(a).alias("label")) for p, a in BASE]), lambda b: F.contains(F.col("_w"), b.p))
    df = df.withColumns({
        "n_base": (F.size("_base") - 1).cast("long"),
        "first_word": F.when(F.size("_base") > 1, _blanks(F.col("_base")[0]) - 1),
        "last_word": F.when(F.size("_base") > 1, F.col("n_words") - _blanks(F.element_at("_base", -1))),
        "base_labels": F.when(F.size("_base") > 1, F.array_sort(F.transform(base, lambda b: b.label))).otherwise(F.array().cast("array<string>")),
        "detections": F.filter("_hits", lambda h: ~F.exists("_hits", lambda g: (g.start <= h.start) & (g.stop >= h.stop) & (
            (g.priority > h.priority)
            | ((g.priority == h.priority) & (g.stop - g.start > h.stop - h.start))
            | ((g.priority == h.priority) & (g.stop - g.start == h.stop - h.start) & (g.rule < h.rule))))),
    }).drop("_hits", "_w", "_base")
    return df.withColumns({
        "labels": F.array_sort(F.array_distinct(F.concat("base_labels", F.transform("detections", lambda d: d.label)))),
        "score": F.coalesce(F.array_max(F.transform("detections", lambda d: d.score)), F.lit(0.0)),
    })


def _detections(table: Column) -> Column:
    """All matches of the rules whose keyword occurs, with their intervals in the text of words."""

    def matches(rule: Column) -> Column:
        found = F.regexp_extract_all(F.col("_w"), rule.pattern, 0)
        between = F.split(F.col("_w"), rule.pattern, -1)
        width = lambda parts, n: F.aggregate(F.slice(parts, F.lit(1), n), F.lit(0), lambda t, x: t + F.length(x))

        def placed(text: Column, i: Column) -> Column:
            start = width(between, i + 1) + width(found, i)
            return F.struct(rule.rule.alias("rule"), rule.label.alias("label"), start.alias("start"), (start + F.length(text)).alias("stop"), rule.priority.alias("priority"), rule.score.alias("score"))

        return F.transform(found, placed)

    return F.flatten(F.transform(F.filter(table, lambda r: F.contains(F.col("_w"), r.keyword)), matches))
