"""License statements by ordered signature rules with a keyword prefilter.

Every license family below gives one rule per form (identifier tag, grant, address, title), and the
wordings of license bodies and of the notices in file headers are rules of their own, a few hundred
regular expressions in all. A rule is tried only on texts that hold its keywords; they are looked up
once per block of texts, those of two letters as whole words. Of overlapping detections, one that lies
inside another of higher priority, or of the same priority and greater length, is dropped: a body that
goes on to a third clause hides the opening it shares with the two-clause body.

A version number behind the name of a product ("Apache 2.4") is no license; without the word itself
such a name counts only behind a grant. "Licence" counts as "license" in names.

Words are runs of digits, letters and non-ASCII characters after A-Z are lowered; separators between
the words of a signature are free. Defined cases: a NULL text counts as empty; a text without words
has no places and score 0; repeated rows are judged alike; an empty table gives no rows; other
columns are left as they are. Texts are searched whole.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leaguelake.llm.textbuf import LOWER, NOT_ALNUM, Block, Words, blocks, words

# Label, keyword every mention holds (one word, since separators are free), name (words of its title), identifier, address.
FAMILIES = (
    ("0bsd", "0bsd|zero", "(?:0bsd|zero clause bsd)", "0bsd", "opensource org licenses 0bsd"),
    ("afl-3.0", "academic", "academic free license(?: v(?:ersion)?)? 3 0", "afl 3 0", "opensource org licenses afl 3 0"),
    ("agpl-3.0", "affero|agpl", "(?:gnu affero general public license(?: v(?:ersion)?)? ?3|agplv?3|agpl 3 0)", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    ("apache-1.1", "apache", "apache(?: software)? license(?: v(?:ersion)?)? 1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", "apache", "(?:apache(?: software)? license(?: v(?:ersion)?)? 2(?: 0)?|apache 2(?: 0)? license)(?! [0-9])", "apache 2 0", "apache org licenses license 2 0"),
    ("apsl-2.0", "apple", "apple public source license(?: v(?:ersion)?)?(?: 2 0)?", "apsl 2 0", "opensource apple com license apsl"),
    ("artistic-1.0", "artistic", "artistic license(?: v(?:ersion)?)? 1 0", "artistic 1 0", "opensource org licenses artistic 1 0"),
    ("artistic-2.0", "artistic", "artistic license(?: v(?:ersion)?)? 2 0", "artistic 2 0", "opensource org licenses artistic 2 0"),
    ("beerware", "beer", "beer ?ware license", "beerware", "people freebsd org phk"),
    ("blueoak-1.0.0", "blue", "blue oak model license(?: 1 0 0)?", "blueoak 1 0 0", "blueoakcouncil org license 1 0 0"),
    ("bsd-2-clause", "bsd", "(?:(?:bsd 2 clause|2 clause bsd|simplified bsd)(?: license)?|freebsd license)", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: license)?", "bsd 3 clause(?: clear)?", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?", "bsd 4 clause", "directory fsf org wiki license bsd 4clause"),
    ("bsl-1.0", "boost", "boost software license(?: v(?:ersion)?)?(?: 1 0)?", "bsl 1 0", "boost org license 1 0"),
    ("busl-1.1", "business", "business source license(?: 1 1)?", "busl 1 1", "mariadb com bsl11"),
    ("cc0-1.0", "cc0|zero", "(?:cc0(?: 1 0)?|creative commons zero)", "cc0 1 0", "creativecommons org publicdomain zero"),
    ("cc-by", "cc|attribution", "(?:cc by v?[1-4] [0-9]|creative commons attribution(?: v?[1-4] [0-9])?)(?! n| s)", "cc by [1-4] [0-9]", "creativecommons org licenses by [1-4]"),
    ("cc-by-nc", "cc|commercial", "(?:cc by nc|creative commons attribution non ?commercial)(?: v?[1-4] [0-9])?(?! n| s)", "cc by nc [1-4] [0-9]", "creativecommons org licenses by nc [1-4]"),
    ("cc-by-nc-nd", "cc|deriv", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv[a-z]+)(?: v?[1-4] [0-9])?", "cc by nc nd [1-4] [0-9]", "creativecommons org licenses by nc nd"),
    ("cc-by-nc-sa", "cc|alike", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: v?[1-4] [0-9])?", "cc by nc sa [1-4] [0-9]", "creativecommons org licenses by nc sa"),
    ("cc-by-nd", "cc|deriv", "(?:cc by nd|creative commons attribution no ?deriv[a-z]+)(?: v?[1-4] [0-9])?", "cc by nd [1-4] [0-9]", "creativecommons org licenses by nd"),
    ("cc-by-sa", "cc|alike", "(?:cc by sa|creative commons attribution share ?alike)(?: v?[1-4] [0-9])?", "cc by sa [1-4] [0-9]", "creativecommons org licenses by sa"),
    ("cddl-1.0", "cddl|development", "(?:cddl(?: 1 0)?|common development and distribution license(?: v(?:ersion)?)?(?: 1 0)?)", "cddl 1 0", "opensource org licenses cddl"),
    ("cecill-2.1", "cecill", "cecill(?: v(?:ersion)?)?(?: 2(?: 1)?)?", "cecill 2 1", "cecill info licences"),
    ("cpl-1.0", "common", "common public license(?: v(?:ersion)?)?(?: 1 0)?", "cpl 1 0", "opensource org licenses cpl1 0"),
    ("ecl-2.0", "educational", "educational community license(?: v(?:ersion)?)?(?: 2 0)?", "ecl 2 0", "opensource org licenses ecl 2 0"),
    ("efl-2.0", "eiffel", "eiffel forum license(?: v(?:ersion)?)?(?: 2)?", "efl 2 0", "opensource org licenses efl 2 0"),
    ("elastic-2.0", "elastic", "elastic license(?: v(?:ersion)?)?(?: 2 0)?", "elastic 2 0", "elastic co licensing elastic license"),
    ("epl-1.0", "eclipse", "eclipse public license(?: v(?:ersion)?)? 1 0", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", "eclipse public license(?: v(?:ersion)?)? 2 0", "epl 2 0", "eclipse org legal epl 2 0"),
    ("eupl-1.2", "european", "european union public licen[cs]e(?: v(?:ersion)?)?(?: 1 2)?", "eupl 1 2", "joinup ec europa eu collection eupl"),
    ("gfdl-1.3", "documentation", "gnu free documentation license(?: v(?:ersion)?)?(?: 1 [0-9])?", "gfdl 1 3(?: only| or later)?", "gnu org licenses fdl"),
    ("gpl-2.0", "general|gpl", "(?:(?:gnu )?general public license(?: v(?:ersion)?)? 2(?: 0)?|gplv?2|gpl(?: v(?:ersion)?)? 2(?: 0)?)", "gpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3.0", "general|gpl", "(?:(?:gnu )?general public license(?: v(?:ersion)?)? 3(?: 0)?|gplv?3|gpl(?: v(?:ersion)?)? 3(?: 0)?)", "gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    ("hpnd", "historical", "historical permission notice and disclaimer", "hpnd", "opensource org licenses hpnd"),
    ("icu", "licen", "icu license", "icu", "source icu project org repos icu"),
    ("ipl-1.0", "ibm", "ibm public license(?: v(?:ersion)?)?(?: 1 0)?", "ipl 1 0", "opensource org licenses ipl 1 0"),
    ("isc", "licen", "isc license", "isc", "opensource org licenses isc"),
    ("lgpl-2.1", "lesser|lgpl", "(?:(?:gnu )?lesser general public license(?: v(?:ersion)?)? 2 1|lgplv?2 1|lgpl(?: v(?:ersion)?)? 2 1)", "lgpl 2 1(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "lesser|lgpl", "(?:(?:gnu )?lesser general public license(?: v(?:ersion)?)? 3(?: 0)?|lgplv?3|lgpl(?: v(?:ersion)?)? 3(?: 0)?)", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    ("lppl-1.3c", "latex", "latex project public license(?: v(?:ersion)?)?(?: 1 3c?)?", "lppl 1 3c", "latex project org lppl"),
    ("mit", "licen", "(?:mit license|expat license|x11 license)", "mit", "opensource org licenses mit"),
    ("mit-0", "attribution", "mit no attribution", "mit 0", "github com aws mit 0"),
    ("mpl-1.1", "mozilla|mpl", "(?:mozilla public license(?: v(?:ersion)?)? 1 1|mpl 1 1)", "mpl 1 1", "mozilla org mpl 1 1"),
    ("mpl-2.0", "mozilla|mpl", "(?:mozilla public license(?: v(?:ersion)?)? 2 0|mpl 2 0)", "mpl 2 0", "mozilla org mpl 2 0"),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl", "opensource org licenses ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl", "opensource org licenses ms rl"),
    ("mulanpsl-2.0", "mulan", "mulan (?:permissive software license|psl)(?: v(?:ersion)?)?(?: ?2)?", "mulanpsl 2 0", "license coscl org cn mulanpsl2"),
    ("ncsa", "illinois", "university of illinois ncsa open source license", "ncsa", "opensource org licenses ncsa"),
    ("odbl-1.0", "database|odbl", "(?:open (?:data commons open )?database license|odbl)(?: v?1 0)?", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("ofl-1.1", "font", "(?:sil )?open font license(?: v(?:ersion)?)?(?: 1 1)?", "ofl 1 1", "scripts sil org ofl"),
    ("openssl", "openssl", "openssl license", "openssl", "openssl org source license"),
    ("osl-3.0", "software", "open software license(?: v(?:ersion)?)?(?: 3 0)?", "osl 3 0", "opensource org licenses osl 3 0"),
    ("php-3.01", "licen", "php license(?: v(?:ersion)?)?(?: 3 01)?", "php 3 01", "php net license 3 01"),
    ("postgresql", "postgresql", "postgresql license", "postgresql", "postgresql org about licen[cs]e"),
    ("psf-2.0", "python", "python software foundation license(?: v(?:ersion)?)?(?: 2)?", "psf 2 0", "docs python org 3 license"),
    ("sspl-1.0", "server|sspl", "(?:server side public license|sspl)(?: v?1)?", "sspl 1 0", "mongodb com licensing server side public license"),
    ("unlicense", "unlicense", "unlicense", "unlicense", "unlicense org"),
    ("upl-1.0", "universal", "universal permissive license(?: v(?:ersion)?)?(?: 1 0)?", "upl 1 0", "opensource org licenses upl"),
    ("vim", "licen", "vim license", "vim", "vimhelp org uganda"),
    ("w3c", "w3c", "w3c software (?:notice and )?license", "w3c", "w3 org consortium legal"),
    ("wtfpl", "wtfpl|want", "(?:wtfpl|do what the [a-z]+ you want to public license)", "wtfpl", "wtfpl net"),
    ("zlib", "zlib", "zlib(?: libpng)? license", "zlib", "opensource org licenses zlib"),
    ("zpl-2.1", "zope", "zope public license(?: v(?:ersion)?)?(?: 2 1)?", "zpl 2 1", "opensource org licenses zpl"),
)

GRANT = "(?:licen[cs]ed|released|distributed|available|published|provided|used) under(?: the)?(?: terms of(?: the)?)? "
# form: keyword, words before, words after, priority, confidence; the part of the family it uses
FORMS = (
    ("identifier", "spdx", "spdx license identifier ", "", 4, 0.99),
    ("name", "under", GRANT, "", 3, 0.95),
    ("address", "http", "https? (?:www )?", "", 2, 0.9),
    ("name", "", "", "", 1, 0.7),
)

# Wordings of bodies and notices: label, words every match holds, wording (<9>: up to nine words of
# any kind), priority, confidence. Openings that several licenses share stand below what goes further.
DEAL = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files(?: the software)? to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so "
)
FORMS_OF_USE = "redistribution and use in source and binary forms with or without modification are permitted"
ENDORSE = "(?:neither the name|the names?) <16> be used to endorse or promote products derived from this software"
ANY_PURPOSE = "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted "
PUBLISHED = "general public license as published by the free software foundation (?:either )?version "
WORDINGS = (
    ("mit", "hereby charge", "permission is hereby granted free of charge to any person obtaining a copy of this software", 5, 0.8),
    ("mit", "hereby charge furnished", DEAL + "subject to the following conditions", 6, 0.98),
    ("mit-0", "hereby charge furnished", DEAL + "the software is provided as is", 6, 0.98),
    ("x11", "hereby charge consortium", DEAL + "<160> except as contained in this notice the name of the x consortium", 7, 0.98),
    ("json", "evil", "the software shall be used for good not evil", 6, 0.98),
    ("bsl-1.0", "hereby charge organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", 6, 0.98),
    ("bsd-2-clause", "redistribution", FORMS_OF_USE, 5, 0.8),
    ("bsd-3-clause", "redistribution endorse", FORMS_OF_USE + " <160> " + ENDORSE, 6, 0.98),
    ("bsd-4-clause", "redistribution endorse advertising", FORMS_OF_USE + " <120> all advertising materials <60> " + ENDORSE, 7, 0.98),
    ("isc", "hereby fee appear", ANY_PURPOSE + "provided that the above copyright notice and this permission notice appear in all copies", 6, 0.98),
    ("0bsd", "hereby fee provided", ANY_PURPOSE + "the software is provided as is", 6, 0.98),
    ("hpnd", "hereby fee documentation", "permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted", 6, 0.95),
    ("postgresql", "hereby fee agreement", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", 6, 0.98),
    ("zlib", "liable altered", "in no event will the authors? be held liable for any damages arising from the use of this software <60> altered source versions must be plainly marked", 6, 0.98),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 6, 0.98),
    ("beerware", "retain stuff", "as long as you retain this notice you can do whatever you want with this stuff", 6, 0.98),
    ("wtfpl", "verbatim changed", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed", 6, 0.98),
    ("cc0-1.0", "waived neighboring", "to the extent possible under law <16> waived all copyright and related or neighboring rights", 6, 0.98),
    ("apache-2.0", "contributor agreements", "licensed to the apache software foundation(?: asf)? under one or more contributor license agreements", 6, 0.95),
    ("apache-2.0", "under apache", GRANT + "apache(?: v(?:ersion)?)? 2(?: 0)?(?! [0-9])", 3, 0.95),
    ("cc-by", "under cc", GRANT + "(?:a )?cc by(?! n| s| [0-9])", 3, 0.9),
    ("gpl-2.0", "general published", "gnu " + PUBLISHED + "2", 6, 0.98),
    ("gpl-3.0", "general published", "gnu " + PUBLISHED + "3", 6, 0.98),
    ("lgpl-2.0", "library published", "gnu library " + PUBLISHED + "2", 6, 0.98),
    ("lgpl-2.1", "lesser published", "gnu lesser " + PUBLISHED + "2 1", 6, 0.98),
    ("lgpl-3.0", "lesser published", "gnu lesser " + PUBLISHED + "3", 6, 0.98),
    ("agpl-3.0", "affero published", "gnu affero " + PUBLISHED + "3", 6, 0.98),
    ("mpl-2.0", "mozilla form", "this source code form is subject to the terms of the mozilla public license(?: v(?:ersion)?)? 2 0", 6, 0.98),
    ("epl-2.0", "eclipse accompanying", "(?:this program and the )?accompanying materials are made available under the terms of the eclipse public license(?: v(?:ersion)?)? 2 0", 6, 0.98),
    ("ms-pl", "governs accompanying", "this license governs use of the accompanying software if you use the software you accept this license", 5, 0.8),
    ("bsd", "bsd", "bsd(?: style| type)? licen[cs]es?", 0, 0.6),
)
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
BASE_CONFIDENCE = 0.5

_WORD = "0-9a-z\\x80-\\xff"


def signature(spaced: str) -> re.Pattern[bytes]:
    """A pattern whose spaces stand for any separators, on lower-case bytes, at word borders.

    `` <n>`` stands for up to n words of any kind; separators and words share no character, so a try is
    linear in what it reads.
    """
    gap = f"[^{_WORD}]+"
    skipped = re.sub(" <([0-9]+)>", lambda m: f"(?: [{_WORD}]+){{0,{m[1]}}}?", spaced)
    optional = skipped.replace(" ?", f"(?:{gap})?")
    return re.compile(f"(?<![{_WORD}])(?:{optional.replace(' ', gap)})(?![{_WORD}])".encode())


@dataclass(frozen=True)
class Rule:
    label: str
    keywords: tuple[frozenset[bytes], ...]  # of each set, the text must hold one
    pattern: re.Pattern[bytes]
    priority: int
    confidence: float


@functools.cache
def rules() -> tuple[Rule, ...]:
    out = []
    for label, keyword, name, identifier, address in FAMILIES:
        part = {"name": name, "identifier": identifier, "address": address}
        own = frozenset(k.encode() for k in keyword.split("|"))
        for used, word, before, after, priority, confidence in FORMS:
            needs = ([own] if used == "name" else []) + ([frozenset([word.encode()])] if word else [])
            spelled = re.sub(r"\blicense\b", "licen[cs]e", part[used]) if used == "name" else part[used]
            out.append(Rule(label, tuple(needs), signature(before + spelled + after), priority, confidence))
    for label, held, wording, priority, confidence in WORDINGS:
        needs = tuple(frozenset([word.encode()]) for word in held.split())
        out.append(Rule(label, needs, signature(wording), priority, confidence))
    return tuple(out)


@functools.cache
def base_rules() -> tuple[tuple[str, re.Pattern[bytes]], ...]:
    return tuple((label, signature(phrase)) for label, phrase in BASE)


@functools.cache
def keywords() -> tuple[bytes, ...]:
    return tuple(sorted({b"license"} | {k for rule in rules() for one in rule.keywords for k in one}))


def held_keywords(block: Block, lowered: bytes, found: Words) -> dict[int, set[bytes]]:
    """The keywords each text holds; texts without any are left out."""
    out: dict[int, set[bytes]] = {}
    pairs = found.starts[found.ends - found.starts == 2]
    first, second = LOWER[block.data[pairs]], LOWER[block.data[pairs + 1]]
    for keyword in keywords():
        if len(keyword) == 2:
            at = pairs[(first == keyword[0]) & (second == keyword[1])]
            for i in np.unique(np.searchsorted(block.offsets, at, "right") - 1).tolist():
                out.setdefault(i, set()).add(keyword)
            continue
        at = lowered.find(keyword)
        while at >= 0:
            i = int(np.searchsorted(block.offsets, at, "right")) - 1
            end = int(block.offsets[i + 1])
            if at + len(keyword) <= end:
                out.setdefault(i, set()).add(keyword)
                at = lowered.find(keyword, end)
            else:
                at = lowered.find(keyword, at + 1)
    return out


def resolve(found: list[tuple[int, int, int, str, float]]) -> list[tuple[int, int, int, str, float]]:
    """Drop (start, end, priority, ...) detections inside stronger ones; one sweep by start."""
    kept, reach = [], {}
    for one in sorted(found, key=lambda x: (x[0], -x[1], -x[2], x[3])):
        if not any(priority >= one[2] and end >= one[1] for priority, end in reach.items()):
            kept.append(one)
        reach[one[2]] = max(reach.get(one[2], -1), one[1])
    return kept


def detect(text: bytes, held: set[bytes]) -> list[tuple[int, int, int, str, float]]:
    found = []
    for rule in rules():
        if all(one & held for one in rule.keywords):
            for m in rule.pattern.finditer(text):
                found.append((m.start(), m.end(), rule.priority, rule.label, rule.confidence))
    return resolve(found)


def with_licenses(docs: DataFrame) -> DataFrame:
    """``doc_id``, the base places, labels, ``score`` and ``detections`` (label, byte span, confidence)."""
    spans = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())]))
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column("text")):
                found = words(block, NOT_ALNUM)
                lowered = LOWER[block.data].tobytes()
                held = held_keywords(block, lowered, found)
                n = len(block)
                places, first, last, score = [0] * n, [None] * n, [None] * n, [0.0] * n
                base, labels, detections = [""] * n, [""] * n, [[] for _ in range(n)]
                for i, words_held in held.items():
                    lo, hi = int(block.offsets[i]), int(block.offsets[i + 1])
                    text = lowered[lo:hi]
                    own, starts = set(), []
                    if b"license" in words_held:
                        for label, pattern in base_rules():
                            hits = [m.start() for m in pattern.finditer(text)]
                            own.update([label] if hits else [])
                            starts += hits
                    kept = detect(text, words_held)
                    if starts:
                        order = np.searchsorted(found.starts, np.array(starts) + lo) - found.bounds[i]
                        places[i], first[i], last[i] = len(starts), int(order.min()), int(order.max())
                    base[i] = ",".join(sorted(own))
                    labels[i] = ",".join(sorted(own | {x[3] for x in kept}))
                    score[i] = max([BASE_CONFIDENCE * bool(own), *(x[4] for x in kept)])
                    detections[i] = [{"label": x[3], "start": x[0], "end": x[1], "confidence": x[4]} for x in kept]
                ids = batch.column("doc_id").slice(block.lo, n)
                whole = [pa.array(x, pa.int64()) for x in (found.counts, places, first, last)]
                strings = [pa.array(x, pa.string()) for x in (base, labels)]
                rest = [pa.array(score, pa.float64()), pa.array(detections, spans)]
                yield pa.RecordBatch.from_arrays([ids, *whole, *strings, *rest], names)

    schema = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, "
        "detections array<struct<label: string, start: long, end: long, confidence: double>>"
    )
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(task, schema)
