"""Licence detection by ordered signature rules, in DataFrame expressions only.

A text is normalised to its lower-cased words (digits, letters, non-ASCII) with single spaces between. The
rules are regular expressions over that form, each with a label, a family keyword, a priority and a
confidence. A rule runs only in texts that hold its keyword, which every match of it holds; a text without
any keyword runs none. All matches of a text, as intervals of the normalised form, are resolved by priority,
then by length: one that overlaps a stronger one in part is suppressed (of equal intervals the strongest
stays), and of those left, whatever lies inside another is suppressed too. A match that a suppressed one
alone would have contained therefore stays. Intervals that form no chain of overlaps are resolved apart.

Besides, the base phrases are located word by word.

Defined results: a null or empty text has 0 words and no labels; ids may be null or repeated; an empty
table gives an empty result; other columns are ignored; whole texts are searched, however long.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import columns

#: Base phrases and their labels.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes that separate words, once A-Z are lower case.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LIC = "licen[cs]e"
VAGUE = "unknown"


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched between spaces of the normalised text that holds ``keyword`` as a word, or as
    the beginning of one if ``keyword`` ends with ``*``."""

    label: str
    keyword: str
    pattern: str
    priority: int
    confidence: float

    @property
    def gate(self) -> str:
        return f" {self.keyword[:-1]}" if self.keyword.endswith("*") else f" {self.keyword} "


def _gnu() -> list[Rule]:
    out = []
    names = {"gpl": "general public", "lgpl": "(?:lesser|library) general public", "agpl": "affero general public"}
    versions = {"gpl": ("1", "2", "3"), "lgpl": ("2", "2 1", "3"), "agpl": ("1", "3")}
    for short, name in names.items():
        for v in versions[short]:
            dot = v.replace(" ", ".")
            number = f"(?:v|version |v )?{v}(?: 0)?" if " " not in v else f"(?:v|version |v )?{v}"
            for words, key in ((f"gnu {name} (?:public )?{_LIC}", "gnu"), (f"{name} {_LIC}", "general"), (f"(?:gnu )?{short}", short)):
                out += [Rule(f"{short}-{dot}-or-later", key, f"{words}(?: as published by the free software foundation)?(?: either)? {number}(?: of the {_LIC})?(?: or)?(?: at your option)? (?:or )?(?:any )?later(?: version)?", 9, 1.0),
                        Rule(f"{short}-{dot}", key, f"{words} {number}(?: only)?", 8, 0.95)]
            out += [Rule(f"{short}-{dot}", f"{short}*", f"{short}v{v}", 8, 0.95), Rule(f"{short}-{dot}-or-later", f"{short}*", f"{short}v?{v} ?(?:plus|or later)", 9, 1.0)]
        out.append(Rule(short, "general" if short != "agpl" else "affero", f"(?:gnu )?{name} {_LIC}", 4, 0.7))
    for v in ("1 1", "1 2", "1 3"):
        out.append(Rule(f"gfdl-{v.replace(' ', '.')}", "gnu", f"gnu free documentation {_LIC}(?: version)? {v}", 8, 0.95))
    out.append(Rule("gfdl", "gnu", f"gnu free documentation {_LIC}", 4, 0.7))
    return out


def _creative_commons() -> list[Rule]:
    out = []
    words = {"by": "attribution", "sa": "share ?alike", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?"}
    for parts in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
        label = "cc-" + parts.replace(" ", "-")
        name = " ".join(words[p] for p in parts.split())
        for v in ("1 0", "2 0", "2 5", "3 0", "4 0"):
            dot = v.replace(" ", ".")
            out += [Rule(f"{label}-{dot}", "cc", f"cc {parts} {v}", 9, 1.0),
                    Rule(f"{label}-{dot}", "creative", f"creative commons {name} {v}(?: international| unported| generic)?(?: public)?(?: {_LIC})?", 9, 1.0),
                    Rule(f"{label}-{dot}", "creativecommons", f"creativecommons org licenses {parts} {v}", 9, 1.0)]
        out += [Rule(label, "cc", f"cc {parts}", 5, 0.8), Rule(label, "creative", f"creative commons {name}(?: {_LIC})?", 5, 0.8)]
    out += [Rule("cc0-1.0", "cc0", "cc0(?: 1 0)?(?: universal)?", 8, 0.95), Rule("cc0-1.0", "creativecommons", "creativecommons org publicdomain zero 1 0", 8, 0.95),
            Rule("cc", "creative", f"creative commons {_LIC}", 2, 0.5)]
    return out


def _versioned() -> list[Rule]:
    """Families whose licences differ by version only: label, keyword, long name, short name, versions."""
    families = (
        ("apache", "apache", f"apache(?: software)?(?: {_LIC})?", "apache", ("1 0", "1 1", "2 0", "2")),
        ("mpl", "mozilla", f"mozilla public {_LIC}", "mpl", ("1 0", "1 1", "2 0")),
        ("epl", "eclipse", f"eclipse public {_LIC}", "epl", ("1 0", "2 0")),
        ("eupl", "european", f"european union public {_LIC}", "eupl", ("1 0", "1 1", "1 2")),
        ("cddl", "common", f"common development and distribution {_LIC}", "cddl", ("1 0", "1 1")),
        ("cpl", "common", f"common public {_LIC}", "cpl", ("1 0",)),
        ("osl", "open", f"open software {_LIC}", "osl", ("1 0", "2 0", "2 1", "3 0")),
        ("afl", "academic", f"academic free {_LIC}", "afl", ("1 1", "1 2", "2 0", "2 1", "3 0")),
        ("artistic", "artistic", f"artistic {_LIC}", "artistic", ("1 0", "2 0")),
        ("bsl", "boost", f"boost software {_LIC}", "bsl", ("1 0",)),
        ("ofl", "sil", f"sil open font {_LIC}", "ofl", ("1 0", "1 1")),
        ("lppl", "latex", f"latex project public {_LIC}", "lppl", ("1 0", "1 2", "1 3")),
        ("ms-pl", "microsoft", f"microsoft public {_LIC}", "ms pl", ("1 0",)),
        ("odbl", "database", f"open (?:data commons )?(?:open )?database {_LIC}", "odbl", ("1 0",)),
        ("upl", "universal", f"universal permissive {_LIC}", "upl", ("1 0",)),
        ("zpl", "zope", f"zope public {_LIC}", "zpl", ("1 1", "2 0", "2 1")),
        ("php", "php", f"php {_LIC}", "php", ("3 0", "3 01")),
        ("ecl", "educational", f"educational community {_LIC}", "ecl", ("1 0", "2 0")),
    )
    out = []
    for label, key, long, short, versions in families:
        for v in versions:
            dot = v.replace(" ", ".") if " " in v else v
            out += [Rule(f"{label}-{dot}", key, f"{long} (?:v|version |v )?{v}", 8 if " " in v else 7, 0.95),
                    Rule(f"{label}-{dot}", short.split()[0], f"{short} (?:v|version )?{v}", 8 if " " in v else 7, 0.9)]
        if long.endswith(_LIC):
            out.append(Rule(label, key, long, 4, 0.7))
    out.append(Rule("apache", "apache", f"apache {_LIC}", 4, 0.7))
    return out


def _single() -> list[Rule]:
    """Licences known by a name or a sentence of their text."""
    rows = (
        ("mit", "mit", f"(?:under|by)(?: the)?(?: terms of the)? mit {_LIC}", 8, 1.0),
        ("mit", "mit", f"(?:the )?mit {_LIC}", 7, 0.9),
        ("mit", "spdx", f"spdx {_LIC} identifier mit", 9, 1.0),
        ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software", 8, 0.9),
        ("isc", "isc", f"isc {_LIC}", 7, 0.9),
        ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 8, 0.9),
        ("bsd-2-clause", "clause", f"(?:bsd 2|2|two) clause (?:bsd )?(?:simplified )?{_LIC}", 8, 0.95),
        ("bsd-3-clause", "clause", f"(?:bsd 3|3|three) clause (?:bsd )?(?:new )?{_LIC}", 8, 0.95),
        ("bsd-4-clause", "clause", f"(?:bsd 4|4|four) clause (?:bsd )?{_LIC}", 8, 0.95),
        ("bsd-2-clause", "bsd", "bsd 2 clause", 7, 0.9),
        ("bsd-3-clause", "bsd", "bsd 3 clause", 7, 0.9),
        ("bsd-4-clause", "bsd", "bsd 4 clause", 7, 0.9),
        ("bsd-0-clause", "0bsd", "0bsd", 7, 0.9),
        ("bsd", "bsd", f"bsd(?: style)? {_LIC}", 4, 0.7),
        ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 6, 0.85),
        ("zlib", "zlib", f"zlib(?: libpng)? {_LIC}", 7, 0.9),
        ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 8, 0.95),
        ("unlicense", "unlicense", "(?:the )?unlicense", 6, 0.85),
        ("wtfpl", "wtfpl", "wtfpl", 7, 0.9),
        ("wtfpl", "fuck", f"do what the fuck you want to public {_LIC}", 8, 0.95),
        ("python", "python", f"python software foundation {_LIC}(?: agreement)?", 7, 0.9),
        ("ruby", "ruby", f"ruby {_LIC}", 6, 0.8),
        ("openssl", "openssl", f"openssl {_LIC}", 7, 0.9),
        ("postgresql", "postgresql", f"postgresql {_LIC}", 7, 0.9),
        ("curl", "curl", f"curl {_LIC}", 6, 0.8),
        ("beerware", "beer*", f"beer ?ware {_LIC}", 6, 0.85),
        ("public-domain", "public", "(?:released |placed )?(?:in|into) the public domain", 5, 0.8),
        ("all-rights-reserved", "reserved", "all rights reserved", 3, 0.6),
        ("proprietary", "proprietary", "proprietary and confidential", 5, 0.8),
        ("open-government-3.0", "government", f"open government {_LIC}(?: v| version)? ?3 0", 7, 0.9),
        ("mit", "liable", "in no event shall the authors or copyright holders be liable for any claim damages or other liability", 5, 0.8),
        ("mit", "notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 7, 0.9),
        ("mit-0", "mit", f"mit no attribution(?: {_LIC})?", 8, 0.95),
        ("mit-0", "mit", f"mit 0(?: {_LIC})?", 8, 0.9),
        ("x11", "x11", f"x11 {_LIC}", 7, 0.9),
        ("expat", "expat", f"expat {_LIC}", 7, 0.9),
        ("bsd-3-clause", "endorse", "(?:may|to) be used to endorse or promote products derived from this software without specific prior written permission", 7, 0.9),
        ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment", 8, 0.95),
        ("bsd", "redistributions", "redistributions of source code must retain the (?:above )?copyright notice", 6, 0.85),
        ("apache-2.0", "apache", f"http www apache org licenses {_LIC} 2 0", 9, 1.0),
        ("apache-2.0", "compliance", f"you may not use this file except in compliance with the {_LIC}", 7, 0.85),
        ("gpl", "foundation", f"free software you can redistribute it and or modify it under the terms of the gnu general public {_LIC} as published by the free software foundation", 6, 0.85),
        ("gpl", "copyleft", f"the gnu general public {_LIC} is a free copyleft {_LIC} for software", 6, 0.9),
        ("gpl", "www", "www gnu org licenses gpl(?: html)?", 5, 0.8),
        ("lgpl", "www", "www gnu org licenses lgpl(?: html)?", 5, 0.8),
        ("agpl", "www", "www gnu org licenses agpl(?: html)?", 5, 0.8),
        ("agpl", "remotely", "all users interacting with it remotely through a computer network", 7, 0.85),
        ("mpl-2.0", "mozilla", f"this source code form is subject to the terms of the mozilla public {_LIC} v 2 0", 9, 1.0),
        ("mpl", "www", "www mozilla org mpl", 5, 0.8),
        ("epl", "www", "www eclipse org legal epl(?: v10| v20| 2 0)?(?: html)?", 6, 0.85),
        ("zlib", "altered", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", 8, 0.95),
        ("zlib", "express", "this software is provided as is without any express or implied warranty in no event will the authors be held liable", 7, 0.85),
        ("bsl-1.0", "boost", f"distributed under the boost software {_LIC} version 1 0", 9, 1.0),
        ("ofl-1.1", "scripts", "scripts sil org ofl", 7, 0.9),
        ("cc0-1.0", "waived", "(?:has )?waived all copyright and related or neighboring rights", 7, 0.9),
        ("public-domain", "dedicate*", "dedicates? (?:any and all copyright interest in )?(?:the|this) (?:software|work) to the public domain", 7, 0.85),
        ("public-domain", "disclaims", "the author disclaims copyright to this source code", 7, 0.85),
        ("jquery", "jquery", f"jquery {_LIC}", 6, 0.8),
        ("json", "evil", "the software shall be used for good not evil", 9, 1.0),
        ("ncsa", "illinois", f"university of illinois(?: ncsa)? open source {_LIC}", 8, 0.95),
        ("w3c", "w3c", f"w3c software(?: notice and)? {_LIC}", 8, 0.9),
        ("icu", "icu", f"icu {_LIC}", 7, 0.85),
        ("unicode", "unicode", f"unicode(?: inc)? {_LIC}(?: agreement)?", 7, 0.85),
        ("libpng", "libpng", f"libpng {_LIC}", 7, 0.85),
        ("libpng", "png", f"png reference library {_LIC}", 7, 0.85),
        ("imagemagick", "imagemagick", f"imagemagick {_LIC}", 7, 0.9),
        ("vim", "vim", f"vim {_LIC}", 7, 0.85),
        ("tcl", "tcl", f"tcl(?: tk)? {_LIC}", 7, 0.85),
        ("mulan-psl", "mulan", f"mulan permissive software {_LIC}", 8, 0.95),
        ("cecill", "cecill", f"cecill(?: free software)? {_LIC}(?: agreement)?", 8, 0.9),
        ("sspl", "server", f"server side public {_LIC}", 8, 0.95),
        ("busl", "business", f"business source {_LIC}", 8, 0.95),
        ("elastic", "elastic", f"elastic {_LIC}", 7, 0.9),
        ("commons-clause", "commons", f"commons clause {_LIC} condition", 8, 0.95),
        ("polyform", "polyform", f"polyform (?:noncommercial|shield|strict|perimeter|small business) {_LIC}", 8, 0.95),
        ("openrail", "openrail*", "openrail(?: m)?", 7, 0.85),
        ("llama-community", "llama", f"llama (?:2|3|3 1|3 2|3 3) community {_LIC}(?: agreement)?", 9, 1.0),
        ("odc-by", "attribution", f"open data commons attribution {_LIC}", 8, 0.95),
        ("pddl", "dedication", f"public domain dedication and {_LIC}", 8, 0.95),
        ("etalab", "etalab", f"etalab(?: open)? {_LIC}", 7, 0.85),
        ("artistic", "perl", "same terms as perl itself", 7, 0.85),
        ("proprietary", "unauthori*", "unauthori[sz]ed (?:copying|use|reproduction|distribution)(?: or [a-z]+)? of this (?:file|software|document|work)(?: [a-z]+ [a-z]+ [a-z]+)? is strictly prohibited", 7, 0.85),
        ("proprietary", "reproduced", "(?:may be|be) reproduced (?:or transmitted )?in any form (?:or by any means )?without (?:the )?(?:prior )?written permission", 6, 0.8),
        ("non-commercial", "commercial", "for non commercial (?:use|purposes) only", 5, 0.7),
        ("non-commercial", "noncommercial", "for noncommercial (?:use|purposes) only", 5, 0.7),
        (VAGUE, "licensed", "licensed under", 1, 0.3),
    )
    return [Rule(*r) for r in rows]


def rules() -> list[Rule]:
    """All rules, in order of priority; built by family, version and way of naming."""
    found = _gnu() + _creative_commons() + _versioned() + _single()
    return sorted(dict.fromkeys(found), key=lambda r: (-r.priority, r.label, r.pattern))


def words_of(text: Column) -> Column:
    """The lower-cased words with single spaces between and one at either end."""
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER, _LOWER)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(low, SEPARATORS, " ")), F.lit(" "))


def _held(words: Column, keywords: list[str]) -> Column:
    """The keywords that stand in the text as words. Without the space before it (which most places of a text
    would begin to match) a keyword is found faster, and few are left to be looked up with it."""
    near = F.filter(F.array(*[F.lit(k.lstrip()) for k in keywords]), lambda k: F.contains(words, k))
    return F.filter(F.transform(near, lambda k: F.concat(F.lit(" "), k)), lambda k: F.contains(words, k))


def _matches(words: Column, chosen: Column) -> Column:
    """All matches of the chosen rules: ``start, stop, -priority, rule`` in characters of ``words``."""
    def of_rule(r: Column) -> Column:
        texts = F.regexp_extract_all(words, r["pattern"], F.lit(0))
        gaps = F.split(words, r["pattern"])
        ends = F.aggregate(
            F.arrays_zip(gaps.alias("g"), texts.alias("t")),
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("found")),
            lambda acc, x: F.when(x["t"].isNull(), acc).otherwise(F.struct(
                (acc["at"] + F.length(x["g"]) + F.length(x["t"])).alias("at"),
                F.concat(acc["found"], F.array(F.struct(
                    (acc["at"] + F.length(x["g"])).alias("start"), (acc["at"] + F.length(x["g"]) + F.length(x["t"])).alias("stop")))).alias("found"))))
        return F.transform(ends["found"], lambda m: F.struct(
            m["start"].alias("start"), (-m["stop"]).alias("minus_stop"), (-r["priority"]).alias("minus_priority"),
            r["label"].alias("label"), r["confidence"].alias("confidence")))
    return F.flatten(F.transform(chosen, of_rule))


_SPAN = "struct<start:int,minus_stop:int,minus_priority:int,label:string,confidence:double>"


def _resolved(matches: Column) -> Column:
    """Matches left by priority and containment, in order of their places."""
    none = F.array().cast(f"array<{_SPAN}>")

    def stronger_first(a: Column, b: Column) -> Column:
        key = lambda m: F.struct(m["minus_priority"], m["start"] + m["minus_stop"], m["start"], m["label"])
        return F.when(key(a) < key(b), -1).when(key(a) > key(b), 1).otherwise(0)

    def holds(o: Column, m: Column) -> Column:
        return (o["start"] <= m["start"]) & (o["minus_stop"] <= m["minus_stop"])

    def barred(kept: Column, m: Column) -> Column:
        """Equal to one that is kept, or overlapping it in part."""
        def by(o: Column) -> Column:
            meet = (o["start"] < -m["minus_stop"]) & (m["start"] < -o["minus_stop"])
            return meet & (holds(o, m) == holds(m, o))
        return F.exists(kept, by)

    def chain(group: Column) -> Column:
        kept = F.aggregate(F.array_sort(group, stronger_first), none, lambda acc, m: F.when(barred(acc, m), acc).otherwise(F.concat(acc, F.array(m))))
        outer = F.transform(F.array(kept), lambda all_: F.filter(all_, lambda m: ~F.exists(all_, lambda o: holds(o, m) & ~holds(m, o))))[0]
        return F.when(F.size(group) < 2, group).otherwise(F.array_sort(outer))

    def step(acc: Column, m: Column) -> Column:
        """``group`` gathers a chain of overlapping intervals, which is resolved at its end."""
        stop = -m["minus_stop"]
        return F.when(m["start"] < acc["stop"], F.struct(acc["done"].alias("done"), F.concat(acc["group"], F.array(m)).alias("group"), F.greatest(acc["stop"], stop).alias("stop"))
                      ).otherwise(F.struct(F.concat(acc["done"], chain(acc["group"])).alias("done"), F.array(m).alias("group"), stop.alias("stop")))

    start = F.struct(none.alias("done"), none.alias("group"), F.lit(0).alias("stop"))
    return F.aggregate(F.array_sort(matches), start, step, lambda acc: F.concat(acc["done"], chain(acc["group"])))


def _base_places(words: Column, phrases: dict[str, str]) -> Column:
    """``(start word, label)`` of every place of every phrase."""
    none = F.array().cast("array<struct<word:bigint,label:string>>")

    split = F.array(F.split(F.trim(words), " "))  # bound to a variable below, so a text is split once

    def places(phrase: str, label: str) -> Column:
        size, wanted = len(phrase.split()), F.array(*[F.lit(x) for x in phrase.split()])

        def of(each: Column) -> Column:
            here = F.filter(F.sequence(F.lit(0), F.size(each) - 1), lambda i: F.slice(each, i + 1, size) == wanted)
            return F.transform(here, lambda i: F.struct(i.cast("long").alias("word"), F.lit(label).alias("label")))

        return F.when(F.contains(words, F.lit(f" {phrase} ")), F.flatten(F.transform(split, of))).otherwise(none)

    found = [places(phrase, label) for phrase, label in phrases.items()]
    return F.concat(*found)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", phrases: dict[str, str] | None = None,
                  ruleset: list[Rule] | None = None) -> DataFrame:
    """Per row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``."""
    phrases, ruleset = phrases or BASE, ruleset or rules()
    by_key: dict[str, list[Rule]] = {}
    for r in ruleset:
        by_key.setdefault(r.gate, []).append(r)
    keys = sorted(by_key)
    table = F.array(*[F.struct(
        F.lit(k).alias("key"), F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(f"(?<= )(?:{r.pattern})(?= )").alias("pattern"),
                                                  F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence"))
                                         for r in by_key[k]]).alias("rules")) for k in keys])
    rows = columns(docs, F.col(id_col).cast("long").alias("doc_id"), words_of(F.col(text_col)).alias("words"))
    rows = rows.withColumn("keys", _held(F.col("words"), keys))
    n_words = F.length("words") - F.length(F.replace("words", F.lit(" "), F.lit(""))) - 1
    n_words = F.when(F.col("words") == "  ", 0).otherwise(n_words)
    rows = rows.select("doc_id", n_words.cast("long").alias("n_words"), "words", "keys")

    chosen = F.flatten(F.transform(F.filter(table, lambda t: F.array_contains(F.col("keys"), t["key"])), lambda t: t["rules"]))
    none = F.array().cast(f"array<{_SPAN}>")
    spans = F.when(F.size("keys") > 0, _resolved(_matches(F.col("words"), chosen))).otherwise(none)
    rows = rows.select("doc_id", "n_words", spans.alias("all_spans"), _base_places(F.col("words"), phrases).alias("base"))

    named = F.filter("all_spans", lambda s: s["label"] != VAGUE)  # a vague hint counts only where nothing is named
    rows = rows.withColumn("spans", F.when(F.size(named) > 0, named).otherwise(F.col("all_spans")))
    label = lambda c: F.transform(c, lambda x: x["label"])
    base_labels = F.array_sort(F.array_distinct(label(F.col("base"))))
    all_labels = F.array_sort(F.array_union(label(F.col("base")), label(F.col("spans"))))
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("spans", lambda s: s["confidence"])), F.lit(0.0)))
    places = F.transform("base", lambda b: b["word"])
    shown = F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["start"].cast("string"), (-s["minus_stop"]).cast("string")))
    return rows.select("doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(places).alias("first_word"),
                       F.array_max(places).alias("last_word"), F.array_join(base_labels, ",").alias("base_labels"),
                       F.array_join(all_labels, ",").alias("labels"), score.alias("score"), F.array_join(shown, ",").alias("spans"))
