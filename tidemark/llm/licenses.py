"""License scan with ordered signature rules. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BODY, KEY, PLAIN_WORD_ANY_CASE, TWIN, ascii_lower, keyed

#: phrase of words, label: these always count
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: A version's number may have a word or letter ahead of it: "version 2", "v2", "v. 2".
_V = r"(?:version )?(?:v ?)?"
#: The lesser, library and Affero licences have labels of their own.
_GENERAL = r"(?<!lesser )(?<!library )(?<!affero )general public licen[cs]e"
_GPL = rf"(?:gnu )?(?:gpl(?: licen[cs]e)? ?|{_GENERAL} ){_V}"
_LGPL = r"(?:lesser|library) general public licen[cs]e"
_AGPL = r"affero general public licen[cs]e"
#: label, gates, how the name is written (over words with one space between). Every way to write a
#: name has one of its gates: a word or phrase, with * the beginning of one, or a name of BESIDE.
FAMILIES = (
    ("gpl-1.0", "gpl*|general public licen*", rf"{_GPL}1(?: 0)?"),
    ("gpl-2.0", "gpl*|general public licen*", rf"{_GPL}2(?: 0)?"),
    ("gpl-3.0", "gpl*|general public licen*", rf"{_GPL}3(?: 0)?"),
    ("gpl", "gpl*|general public licen*", r"(?:gnu (?:gpl|general public licen[cs]e)|gpl licen[cs]e)"),
    ("lgpl-2.1", "lgpl*|lesser general*|library general*", rf"(?:gnu )?(?:lgpl ?|{_LGPL} ){_V}2(?: [01])?"),
    ("lgpl-3.0", "lgpl*|lesser general*", rf"(?:gnu )?(?:lgpl ?|lesser general public licen[cs]e ){_V}3(?: 0)?"),
    ("lgpl", "lgpl*|lesser general*|library general*", rf"(?:gnu )?(?:lgpl|{_LGPL})"),
    ("agpl-3.0", "agpl*|affero general*", rf"(?:gnu )?(?:agpl ?|{_AGPL} ){_V}3(?: 0)?"),
    ("agpl", "agpl*|affero general*", rf"(?:gnu )?(?:agpl|{_AGPL})"),
    ("fdl", "gfdl*|free documentation*", rf"(?:gfdl|gnu free documentation licen[cs]e)(?: version)?(?: ?{_V}1 [123])?"),
    ("apache-1.1", "apache", r"apache (?:software )?license(?: version)? 1 1"),
    ("apache-2.0", "apache", r"apache(?: software)?(?: license)?(?: version)? v?2(?: 0)?"),
    ("apache", "apache", r"apache (?:software )?licen[cs]e"),
    ("mit", "mit|expat", r"(?:mit|expat)(?: x11)? licen[cs]e"),
    ("mit-0", "mit", r"mit (?:no attribution|0)"),
    ("bsd-2-clause", "bsd|freebsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?"),
    ("bsd", "bsd", r"bsd (?:style )?licen[cs]e"),
    ("isc", "isc", r"isc licen[cs]e"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("mpl-1.1", "mozilla|mpl*", rf"(?:mozilla public license |mpl ?){_V}1 1"),
    ("mpl-2.0", "mozilla|mpl*", rf"(?:mozilla public license |mpl ?){_V}2(?: 0)?"),
    ("epl-1.0", "eclipse|epl*", rf"(?:eclipse public license |epl ?){_V}1(?: 0)?"),
    ("epl-2.0", "eclipse|epl*", rf"(?:eclipse public license |epl ?){_V}2(?: 0)?"),
    ("cddl", "cddl*|common development*", rf"(?:cddl|common development and distribution license)(?: version)?(?: ?{_V}1 [01])?"),
    ("eupl", "eupl*|european union*", rf"(?:eupl|european union public licen[cs]e)(?: version)?(?: ?{_V}1 [012])?"),
    ("artistic", "artistic", r"artistic license(?: version)?(?: [12](?: 0)?)?"),
    ("bsl-1.0", "boost|bsl*", rf"(?:boost software license |bsl ?){_V}1(?: 0)?"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl*", rf"wtfpl(?: version)?(?: ?{_V}2)?"),
    ("odbl", "odbl*|database", rf"(?:odbl|odc odbl|open (?:data commons open )?database license)(?: ?{_V}1(?: 0)?)?"),
    ("ofl", "ofl*|font", rf"(?:sil )?(?:ofl|open font license)(?: version)?(?: ?{_V}1 [01])?"),
    ("psf", "python|psf", r"(?:python software foundation|psf) license(?: version)?(?: 2)?"),
    ("cc0", "cc0|creative", r"(?:cc0|creative commons zero)(?: 1 0)?(?: universal)?"),
    ("cc-by", "cc|creative", r"(?:cc by|creative commons attribution)(?: [1-4] [05])?(?: (?:international|unported|generic))?"),
    ("cc-by-sa", "cc|creative", r"(?:cc by sa|creative commons attribution share ?alike)(?: [1-4] [05])?"),
    ("cc-by-nd", "cc|creative", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s(?: works)?)(?: [1-4] [05])?"),
    ("cc-by-nc", "cc|creative", r"(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc|creative", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "cc|creative", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)(?: [1-4] [05])?"),
)
#: Names too short to tell by themselves; they count in the forms of BARE_FORMS.
BARE = (
    ("gpl", "gpl|general public licen*", r"(?:gnu )?(?:gpl|general public licen[cs]e)"),
    ("mit", "bare mit|bare expat", r"(?:mit|expat)(?: x11)?"),
    ("bsd", "bsd", r"bsd"),
    ("isc", "bare isc", r"isc"),
    ("zlib", "bare zlib", r"zlib(?: libpng)?"),
    ("artistic", "bare artistic", r"artistic(?: [12](?: 0)?)?"),
    ("psf", "bare psf", r"psf(?: 2(?: 0)?)?"),
)
#: what stands around a name, confidence; earlier forms are stronger
FORMS = (
    (r"spdx license identifier {name}", 1.0),
    (r"(?:dual |multi )?(?:licensed|licenced|released|distributed|published|available|provided|made available|redistributed) (?:only )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?{name}(?: licen[cs]e)?(?: or (?:any )?later(?: version)?)?", 0.95),
    (r"under (?:the )?(?:terms of )?(?:the |a |an )?{name}(?: licen[cs]e)?", 0.85),
    (r"(?:subject to|governed by|covered by|in accordance with|according to|as per) (?:the )?(?:terms of )?(?:the )?{name}(?: licen[cs]e)?", 0.85),
    (r"licen[cs]e(?: is| as| name| type)? (?:the )?{name}", 0.8),
    (r"(?:permissions?|rights) (?:are |is )?(?:granted|given) (?:by|under) (?:the )?{name}", 0.8),
    (r"{name}", 0.6),
)
#: As above, but "under" alone is weaker, as it may tell of a system or a school.
BARE_FORMS = tuple((form, 0.7 if form.startswith("under") else trust) for form, trust in FORMS[:-1])
#: The words that may stand right before a name in these forms.
_AHEAD = "identifier|under|the|an?|of|to|by|with|per|licen[cs]e|is|as|name|type"
#: signatures that stand alone: label, word, regex, confidence
ALONE = (
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy of this software", 0.95),
    ("isc", "purpose", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 0.95),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted", 0.9),
    ("zlib", "altered", r"altered source versions must be plainly marked as such", 0.9),
    ("wtfpl", "public", r"do what the fuck you want to public license", 0.95),
    ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain", 0.95),
    ("public-domain", "domain", r"(?:in|into|to) the public domain", 0.7),
    ("proprietary", "reserved", r"all rights reserved", 0.7),
    ("proprietary", "confidential", r"(?:proprietary and confidential|confidential and proprietary)", 0.8),
    ("proprietary", "prohibited", r"(?:reproduction|redistribution|copying)(?: or \w+)? (?:is )?(?:strictly )?prohibited", 0.75),
)


def rules() -> list[tuple[int, str, str, str, float]]:
    """(priority, gate, regex, label, confidence), the strongest first: every form of every name, and the rest.

    Within a form, names with more parts come first, so "cc by nc sa" beats "cc by".
    """
    names = sorted(FAMILIES, key=lambda f: (-f[0].count("-"), f[0]))
    forms = [(words, form.format(name=f"(?:{name})"), label, trust) for form, trust in FORMS for label, words, name in names]
    forms += [(words, form.format(name=f"(?:{name})"), label, trust) for form, trust in BARE_FORMS for label, words, name in BARE]
    alone = [(word, regex, label, trust) for label, word, regex, trust in ALONE]
    ordered = sorted(forms + alone, key=lambda r: -r[3])
    return [(i, word, regex, label, trust) for i, (words, regex, label, trust) in enumerate(ordered) for word in words.split("|")]


def _spaces(text):
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def _found(pairs: DataFrame, *carry: str) -> DataFrame:
    """First word and number of words of each match of ``regex`` in ``_norm``, words counted from 0.

    The regex may differ from row to row. Spaces ahead of a match count the words ahead.
    """
    norm, regex = F.col("_norm"), F.expr("concat('(?<= )(?:', regex, ')(?= )')")
    pairs = pairs.withColumn("_rx", regex)
    found = F.regexp_extract_all(norm, F.col("_rx"), F.lit(0))
    gaps = F.split(norm, F.col("_rx"), -1)
    counted = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(_spaces(g).alias("gap"), _spaces(m).alias("len")))
    each = pairs.select(KEY, TWIN, *carry, F.posexplode(counted).alias("no", "m")).select(KEY, TWIN, *carry, "no", "m.*")
    upto = Window.partitionBy(KEY, TWIN, *carry).orderBy("no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.dropDuplicates([KEY, TWIN, *carry, "no"]).withColumn("after", F.sum(F.col("gap") + F.col("len")).over(upto))
    first = F.col("after") - F.col("len") - 1
    return each.select(KEY, TWIN, *carry, first.alias("first"), (F.col("len") + 1).alias("words"))


#: Every match of a rule or phrase has one of these within a word, or a short name as in SHORT.
ROOTS = (
    "licen|gpl|gfdl|apache|spdx|commons|cc0|mpl|epl|bsl|cddl|eupl|odbl|ofl|wtfpl|bsd|domain|reserved|hereby"
    "|redistribution|altered|fuck|unencumbered|confidential|prohibited|attribution"
).split("|")
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Short names that are words of other languages, or too common, count after a word of a form only.
_SHORT_NAMES = ("mit", "expat", "isc", "zlib", "artistic", "psf")
SHORT = (("cc", rf"cc{_GAP}by"), ("mit", rf"mit{_GAP}0"), *((name, rf"(?:{_AHEAD}){_GAP}{name}") for name in _SHORT_NAMES))
BESIDE = {f"bare {name}": (f" {name} ", rf" (?:{_AHEAD}) {name} ") for name in _SHORT_NAMES}


def _may_have(text: Column) -> Column:
    held = F.lit(False)
    for root in ROOTS:
        held = held | F.contains(text, F.lit(root))
    for root, regex in SHORT:
        held = held | (F.contains(text, F.lit(root)) & text.rlike(regex))
    return held


def _opens(norm: Column, gate: str) -> Column:
    """Whether a text in words has what a gate asks for."""
    if gate in BESIDE:
        name, regex = BESIDE[gate]
        return F.contains(norm, F.lit(name)) & norm.rlike(regex)
    return F.contains(norm, F.lit(f" {gate[:-1]}" if gate.endswith("*") else f" {gate} "))


def _rule_table(spark: SparkSession) -> DataFrame:
    """Its size is fixed by the lists above: a few hundred rows, whatever is scanned."""
    return spark.createDataFrame(rules(), "priority int, word string, regex string, label string, trust double")


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, base, found) for every row.

    ``base``: array of (first, label) of all places of the base phrases. ``found``: array of
    (first, words, label, trust) of the rules' detections. A rule is tried only on texts that
    have one of its gates, without which it can't match. A detection that lies within one of higher priority is dropped; of two
    equal stretches the stronger rule's stays. Higher priority means a higher level of confidence, or
    the longer of two detections of one level.

    A null or empty text has no words and no detections. Rows with equal id and text have
    equal results. A null id is carried through. Only the two named columns are read.
    """
    rows = keyed(docs, id_col, text_col)
    keywords = sorted({rule[1] for rule in rules()} | {"gnu", "apache", "cc", "mit"})
    texts = rows.where(F.exists(F.array(F.lower(BODY)), _may_have))  # the array holds the lower-cased text once
    plain = F.trim(F.regexp_replace(ascii_lower(F.col(BODY)), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", " "))
    texts = texts.select(KEY, TWIN, F.concat(F.lit(" "), plain, F.lit(" ")).alias("_norm"))

    spark = docs.sparkSession
    has = F.array_compact(F.array(*[F.when(_opens(F.col("_norm"), w), F.lit(w)) for w in keywords]))
    gated = texts.select("*", F.explode(has).alias("_word"))
    table = _rule_table(spark)
    tried = gated.join(F.broadcast(table), F.col("_word") == table["word"]).drop("word")
    hits = _found(tried, "_word", "priority", "label", "trust").drop("_word")
    hits = hits.dropDuplicates([KEY, TWIN, "priority", "first", "words"])

    phrases = spark.createDataFrame([(p.split(" ")[0], p, label) for p, label in BASE], "word string, regex string, label string")
    base = gated.join(F.broadcast(phrases), F.col("_word") == phrases["word"]).drop("word")
    base = _found(base, "_word", "label").drop("_word")

    stands = _uncontained(hits.withColumn("end", F.col("first") + F.col("words")))

    entry = F.struct("first", "words", "label", "trust")
    stands = stands.groupBy(KEY, TWIN).agg(F.sort_array(F.collect_list(entry)).alias("found"))
    base = base.groupBy(KEY, TWIN).agg(F.sort_array(F.collect_list(F.struct("first", "label"))).alias("base"))
    counted = rows.select(KEY, TWIN, F.regexp_count(BODY, F.lit(PLAIN_WORD_ANY_CASE)).cast("long").alias("n_words"))
    out = _with(_with(counted, base), stands)
    return out.select(
        F.col(KEY).alias("doc_id"),
        "n_words",
        F.coalesce("base", F.array().cast("array<struct<first:bigint,label:string>>")).alias("base"),
        F.coalesce("found", F.array().cast("array<struct<first:bigint,words:int,label:string,trust:double>>")).alias("found"),
    )


#: Confidence levels, strongest first: containment is tested once for each.
LEVELS = sorted({rule[4] for rule in rules()}, reverse=True)


def _uncontained(hits: DataFrame) -> DataFrame:
    """Drops what lies within a detection of an equal or higher level of confidence.

    Whatever can contain a detection comes before it in the order of starts, longest first,
    strongest first; a running maximum of ends for each level then tells, without pairs.
    """
    before = Window.partitionBy(KEY, TWIN).orderBy("first", F.desc("end"), "priority").rowsBetween(Window.unboundedPreceding, -1)
    for i, level in enumerate(LEVELS):
        hits = hits.withColumn(f"_r{i}", F.max(F.when(F.col("trust") == level, F.col("end"))).over(before))
    within = F.lit(False)
    for i, level in enumerate(LEVELS):
        within = within | ((F.col(f"_r{i}") >= F.col("end")) & (F.col("trust") <= level))
    return hits.where(~F.coalesce(within, F.lit(False))).drop(*[f"_r{i}" for i in range(len(LEVELS))])


def _with(left: DataFrame, right: DataFrame) -> DataFrame:
    a, b = left.alias("a"), right.alias("b")
    joined = a.join(b, F.expr(f"a.{KEY} <=> b.{KEY} AND a.{TWIN} = b.{TWIN}"), "left")
    return joined.select("a.*", *[f"b.{c}" for c in right.columns if c not in (KEY, TWIN)])
