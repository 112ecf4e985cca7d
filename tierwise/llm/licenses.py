"""Licence notices in texts, by sentences and ordered rules.

DataFrame functions only. A text is cut into sentences, each is normalised and
looked up among known licence sentences, and the row of identifiers that is
left is matched against rules in order: a rule whose sentences stand in a row
names a licence and consumes them, so that longer rules come before their
parts. All of it is one projection: no shuffle, and a text never leaves its row.

A known sentence may be wrapped: it begins and ends at any line break or end of
a sentence, and single line breaks (with comment marks) may stand inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwise.llm.common import ASCII_LOWER, ASCII_UPPER, read_table, texts

# Identifiers of licence sentences, as they read in lower case
# with everything but letters and digits as one space.
SENTENCES = {
    "apache-grant": "licensed under the apache license version 2 0",
    "apache-grant-the": "licensed under the apache license version 2 0 the license",
    "apache-compliance": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "mit-release": "released under the mit license",
    "mit-license": "licensed under the mit license",
    "mit-grant": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction"
    ),
    "mit-notice": (
        "the above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the software"
    ),
    "as-is": "the software is provided as is without warranty of any kind",
    "gpl3-work": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it",
    "gpl3-terms": (
        "under the terms of the gnu general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version"
    ),
    "bsd-grant": (
        "redistribution and use in source and binary forms with or without modification are permitted provided "
        "that the following conditions are met"
    ),
    "bsd-source": (
        "redistributions of source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer"
    ),
    "bsd-binary": (
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
        "following disclaimer in the documentation and or other materials provided with the distribution"
    ),
    "bsd-names": (
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission"
    ),
    "cc-by-nc-4": "licensed under cc by nc 4 0",
    "cc-by-4": "licensed under cc by 4 0",
    "cc-by-sa-4": "licensed under cc by sa 4 0",
    "all-rights": "all rights reserved",
}

# Licence and the identifiers that stand in a row for it, tried in this order.
RULES = (
    ("Apache-2.0", ("apache-grant-the", "apache-compliance", "apache-copy")),
    ("Apache-2.0", ("apache-grant-the", "apache-compliance")),
    ("Apache-2.0", ("apache-grant-the",)),
    ("Apache-2.0", ("apache-grant",)),
    ("MIT", ("mit-grant", "mit-notice", "as-is")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-release",)),
    ("MIT", ("mit-license",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl3-terms")),
    ("GPL-3.0", ("gpl3-work",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("all-rights-reserved", ("all-rights",)),
)

# Sentences of the standard texts as the splitter yields them, and rules tried before RULES.
TEXT_SENTENCES = {
    "mit-grant-full": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction including without limitation "
        "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to "
        "permit persons to whom the software is furnished to do so subject to the following conditions"
    ),
    "as-is-full": (
        "the software is provided as is without warranty of any kind express or implied including but not limited to "
        "the warranties of merchantability fitness for a particular purpose and noninfringement"
    ),
    "mit-liability": (
        "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether "
        "in an action of contract tort or otherwise arising from out of or in connection with the software or the use "
        "or other dealings in the software"
    ),
    "bsd-advert": (
        "all advertising materials mentioning features or use of this software must display the following acknowledgement"
    ),
}
TEXT_RULES = (
    ("MIT", ("mit-grant-full", "mit-notice", "as-is-full", "mit-liability")),
    ("MIT", ("mit-grant-full", "mit-notice", "as-is-full")),
    ("MIT", ("mit-grant-full", "mit-notice")),
    ("MIT", ("mit-grant-full",)),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-names")),
)

# Families of the GNU licences: name, words, versions.
GNU = (
    ("GPL", ("general public license",), ("2", "3")),
    ("LGPL", ("lesser general public license", "library general public license"), ("2", "2 1", "3")),
    ("AGPL", ("affero general public license",), ("3",)),
)
CC_PARTS = {
    "by": "attribution", "by sa": "attribution sharealike", "by nc": "attribution noncommercial",
    "by nc sa": "attribution noncommercial sharealike", "by nd": "attribution noderivatives",
    "by nc nd": "attribution noncommercial noderivatives",
}
# Names after 'licensed under', besides those of the GNU and CC licences.
NAMES = {
    "MIT": ("mit license", "mit licence", "mit", "expat license"),
    "Apache-2.0": (
        "apache license version 2 0", "apache license 2 0", "apache license v2 0", "apache 2 0 license", "apache 2 0",
        "apache software license version 2 0", "apache software license 2 0",
    ),
    "BSD-2-Clause": ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license", "bsd 2 clause"),
    "BSD-3-Clause": (
        "bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "bsd 3 clause",
    ),
    "ISC": ("isc license", "isc"),
    "MPL-2.0": ("mozilla public license version 2 0", "mozilla public license 2 0", "mpl 2 0", "mpl version 2 0"),
    "CC0-1.0": ("cc0 1 0 universal", "cc0 1 0", "creative commons zero v1 0 universal"),
}
ISC_GRANT = "permission to use copy modify {}distribute this software for any purpose with or without fee is hereby granted"
ISC_REST = " provided that the above copyright notice and this permission notice appear in all copies"


def _notices() -> dict[str, str]:
    """Sentences that name a licence by themselves; 'under x' is any 'licensed under the x'."""
    found = {
        TEXT_SENTENCES["mit-grant-full"].removesuffix(" subject to the following conditions"): "MIT-0",
        "apache license version 2 0 january 2004": "Apache-2.0",
        "this source code form is subject to the terms of the mozilla public license v": "MPL-2.0",
        "mozilla public license version 2 0": "MPL-2.0",
        "cc0 1 0 universal": "CC0-1.0",
    }
    for joint in ("and or ", "and "):
        found[ISC_GRANT.format(joint)] = "0BSD"
        found[ISC_GRANT.format(joint) + ISC_REST] = "ISC"
    names = {licence: list(words) for licence, words in NAMES.items()}
    for family, full, versions in GNU:
        for version in versions:
            licence = f"{family}-{version.replace(' ', '.') if ' ' in version else version + '.0'}"
            for words in full:
                terms = f"you can redistribute it and or modify it under the terms of the gnu {words}"
                fsf = "as published by the free software foundation"
                later = "or at your option any later version"
                found[f"{terms} {fsf} either version {version} of the license {later}"] = f"{licence}-or-later"
                found[f"{terms} {fsf} version {version} of the license"] = f"{licence}-only"
                found[f"{terms} version {version} {fsf}"] = f"{licence}-only"
                date = {"GPL-2": "june 1991", "GPL-3": "29 june 2007", "LGPL-2": "june 1991", "LGPL-2 1": "february 1999",
                        "LGPL-3": "29 june 2007", "AGPL-3": "19 november 2007"}[f"{family}-{version}"]
                found[f"gnu {words} version {version} {date}"] = licence
            for words in (*(f"gnu {w}" for w in full), f"gnu {family.lower()}", family.lower()):
                for number in {version, version if " " in version else f"{version} 0"}:
                    for join in (" version ", " v", " ", "v"):
                        named = f"{words}{join}{number}"
                        names.setdefault(licence, []).append(named)
                        names.setdefault(f"{licence}-only", []).append(f"{named} only")
                        names.setdefault(f"{licence}-or-later", []).extend(
                            f"{named} {later}" for later in ("or later", "or any later version", "or at your option any later version")
                        )
    for short, words in CC_PARTS.items():
        for version, port in (("4 0", "international"), ("3 0", "unported")):
            licence = f"CC-{short.upper().replace(' ', '-')}-{version.replace(' ', '.')}"
            full = f"creative commons {words} {version} {port}"
            names[licence] = [full, f"{full} license", f"creative commons {words} {version}", f"cc {short} {version}"]
    for licence, words in names.items():
        found |= {f"under {w}": licence for w in words}
    for licence in [*names, "MIT-0", "0BSD", "BSD-4-Clause"]:
        found[f"spdx license identifier {licence.lower().replace('-', ' ').replace('.', ' ')}"] = licence
    return found


NOTICES = _notices()
# The identifier of such a sentence is its licence after this.
IS = "is-"

# Words from which a sentence of the standard texts is known without an end of a sentence before it.
LONG_WORDS = 15

# 'This project is licensed under the terms of the ... - see the LICENSE file', whatever 'is' follows.
UNDER = (
    "(?:licensed|released|distributed|available|made available|provided) under (?:the terms of )?(?:the |an? )?"
)
SEE = " see [^E]+?"
# The clause on names, whoever the holder is: what stands before the name, and the name with what follows.
HOLDER_BEFORE = "neither[L ]the[L ]name[L ]of[L ]"
HOLDER_AFTER = "^[a-z0-9L ]+?[L ]nor[L ]the[L ]names[L ]of[L ]its[L ]contributors"

# A sentence ends at a line's end, or at . ! ? : ; before white space or the text's end.
SENTENCE_END = "[.!?:;]+(?:[\\x20\\x09-\\x0D]+|$)|[\\n\\r]+"
NOT_WORD = "[^a-z0-9\\n]+"


def _known_sentences() -> str:
    """Pattern of all known sentences between ends (E) or line breaks (L), which may stand for its spaces."""
    whole = [*SENTENCES.values(), *TEXT_SENTENCES.values(), *(n for n in NOTICES if not n.startswith("under "))]
    names = [n.removeprefix("under ") for n in NOTICES if n.startswith("under ")]
    whole, names = (sorted(x, key=len, reverse=True) for x in (whole, names))
    known = f"(?:{'|'.join(whole)}|{UNDER}(?:{'|'.join(names)})(?:{SEE})?)"
    # Long ones are found after a heading on the same line as well.
    long = [s for s in whole if len(s.split()) >= LONG_WORDS and s not in SENTENCES.values()]
    known = f"(?:(?:(?<![^EL])|(?<=_is_)(?={UNDER})){known}|(?<![^EL_])(?:{'|'.join(long)}))"
    return known.replace(" ", "[L ]").replace("_", " ") + "(?![^EL])"


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in their order."""
    plain = F.translate(text, ASCII_UPPER, ASCII_LOWER)
    # Upper case is free for marks from here on: E ends a sentence, L is a line break.
    for pattern, by in (
        ("spdx-license-identifier:[\\x20\\t]*", "spdx license identifier "),
        ("(gpl-[0-9.]+)\\+", "$1-or-later"),
        ("(spdx license identifier [^\\s]+) with [a-z0-9.-]+", "$1"),
        ("(spdx license identifier [^\\s]+) (?:or|and) ", "$1Espdx license identifier "),
        ("foundation;(?=[^a-z0-9]+(?:either[^a-z0-9]+)?version)", "foundation,"),
        ("[.!?:;]+(?:[\\x20\\x09-\\x0D]+|$)", "E"),
        ("[^a-z0-9E\\n\\r]+", " "),
        (" ?(?>\\r\\n|\\r|\\n) ?", "L"),
        ("L[L ]*L", "E"),
        (" ?([EL]) ?", "$1"),
    ):
        plain = F.regexp_replace(plain, pattern, by)
    # Cut first, so that each name is looked for from one place only, however long a text is.
    anyone = "the copyright holder nor the names of its contributors"
    parts = F.split(plain, HOLDER_BEFORE, -1)
    parts = F.transform(parts, lambda p, i: F.when(i == 0, p).otherwise(F.regexp_replace(p, HOLDER_AFTER, anyone)))
    plain = F.array_join(parts, "neither the name of ")
    found = F.regexp_extract_all(F.btrim(plain, F.lit(" ")), F.lit(_known_sentences()), F.lit(0))
    ids = {n: IS + licence for n, licence in NOTICES.items()}
    ids |= {sentence: name for name, sentence in (TEXT_SENTENCES | SENTENCES).items()}
    names = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])

    def named(sentence: Column) -> Column:
        words = F.translate(sentence, "L", " ")
        short = F.regexp_replace(F.regexp_replace(words, f"^{UNDER}", "under "), f"{SEE}$", "")
        return F.coalesce(F.try_element_at(names, words), F.try_element_at(names, short))

    return F.array_compact(F.transform(found, named))


def scan_licenses(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, sentence_ids, licenses, unmatched per row of `docs`: arrays of
    the known sentences in order, of the licences (each once; those of rules in
    rule order, then those that one sentence names), and of the known sentences
    that no rule consumed.

    A null or empty text, or one without any known sentence, has empty arrays. A
    holder's name of over 1,000 characters hides the clause on names.
    Rows are judged one by one, whatever their id; an empty table gives no row;
    other columns are not read.
    """
    found = texts(docs, id_column, text_column).select("doc_id", sentence_ids(F.col("text")).alias("sentence_ids"))
    # Identifiers between bars, so that a rule is a substring: |a||b||c|.
    rest = F.concat(F.lit("|"), F.array_join("sentence_ids", "||"), F.lit("|"))
    hits = []
    for license_id, sequence in TEXT_RULES + RULES:
        part = "|" + "||".join(sequence) + "|"
        hits.append(F.when(F.contains(rest, F.lit(part)), F.lit(license_id)))
        # What is consumed leaves a break behind, so its neighbours do not become a row.
        rest = F.replace(rest, F.lit(part), F.lit("|#|"))
    left = F.filter(F.split(rest, "\\|+"), lambda s: (s != "") & (s != "#"))
    noted = F.transform(F.filter(left, lambda s: s.startswith(IS)), lambda s: F.substring(s, len(IS) + 1, 1000))
    return found.select(
        "doc_id",
        "sentence_ids",
        F.array_distinct(F.concat(F.array_compact(F.array(*hits)), noted)).alias("licenses"),
        F.filter(left, lambda s: ~s.startswith(IS)).alias("unmatched"),
    )


def op3_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(read_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
        F.array_join("unmatched", ",").alias("unmatched"),
    )


def _op3_sql() -> str:
    names = ", ".join(f"'{sentence}': '{name}'" for name, sentence in SENTENCES.items())
    steps, hits, rest = [], [], "bars"
    for i, (license_id, sequence) in enumerate(RULES):
        part = "|" + "||".join(sequence) + "|"
        steps.append(f"replace({rest}, '{part}', '|#|') AS rest{i}")
        hits.append(f"CASE WHEN contains({rest}, '{part}') THEN '{license_id}' END")
        rest = f"rest{i}"
    return f"""
WITH cut AS (
  SELECT doc_id, list_transform(string_split(regexp_replace(regexp_replace(
      translate(coalesce(text, ''), '{ASCII_UPPER}', '{ASCII_LOWER}'),
      '{SENTENCE_END}', chr(10), 'g'), '{NOT_WORD}', ' ', 'g'), chr(10)), lambda s: trim(s, ' ')) AS sentences
  FROM documents),
named AS (
  SELECT doc_id, list_filter(list_transform(sentences, lambda s: MAP {{{names}}}[s]), lambda x: x IS NOT NULL) AS ids
  FROM cut),
barred AS (SELECT doc_id, ids, '|' || array_to_string(ids, '||') || '|' AS bars FROM named),
matched AS (SELECT *, {", ".join(steps)} FROM barred),
hit AS (SELECT *, list_filter([{", ".join(hits)}], lambda x: x IS NOT NULL) AS hits FROM matched)
SELECT doc_id, CAST(len(ids) AS BIGINT) AS n_sentences, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_filter(hits, lambda x, i: list_position(hits, x) = i), ',') AS licenses,
  array_to_string(list_filter(string_split_regex({rest}, '\\|+'), lambda x: x <> '' AND x <> '#'), ',') AS unmatched
FROM hit
"""


OP3_SQL = _op3_sql()
