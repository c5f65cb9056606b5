"""Licence scan by sentence identifiers and ordered rules, with Spark's own functions.

A text is cut into sentences at blank lines and after ``. ; ! ?`` with a space or line end; lines
without a letter or digit are blank, and other line ends join like spaces, with the comment marks
around them. A sentence is normalised (lower case, everything but letters, digits and dots is one
space, no dot at the ends of its lines) and gets the identifiers of all sentence forms in it, in
their order; of forms that begin at one place, the first listed. The document's identifiers in
order form one string; rules, tried in order, recognise a sequence of neighbours, name a licence
and use the sequence up, so that a long rule goes before the short ones it contains. Identifiers
that no rule uses are reported as left over.

Only texts with a telling word are cut at all; everything stays within its row, so there is
no shuffle and a group of copies or a very long text is like any other.

Defined cases: null or empty text has no sentences and no licence; equal rows get equal
results; a licence found twice is named once, in order of the rules; an empty table gives no
rows; further columns pass through ``scan`` (names starting with ``_lic_`` are refused).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentence forms (identifier, expression on a normalised sentence), first match at a
# place counts. A space stands for a line end too, ``$`` for the end of a line.
SENTENCES = (
    ("SPDX-MIT", r"\bspdx license identifier mit$"),
    ("SPDX-Apache2", r"\bspdx license identifier apache 2\.0$"),
    ("SPDX-GPL3", r"\bspdx license identifier gpl 3\.0( only| or later)?$"),
    ("SPDX-BSD3", r"\bspdx license identifier bsd 3 clause$"),
    ("AGPLgrant3", r"licensed under (the )?(terms of the )?(gnu )?affero general public license( version 3| v3)"),
    ("LGPLgrant", r"licensed under (the )?(terms of the )?(gnu )?(lesser|library) general public license"),
    ("GPLgrant3", r"licensed under (the )?(terms of the )?gnu general public license( version 3| v3)"),
    ("GPLgrant2", r"licensed under (the )?(terms of the )?gnu general public license( version 2| v2)"),
    ("GPLredist", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("AGPLredist", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("LGPLredist", r"you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license"),
    ("GPLversion3", r"(either )?version 3 (of the license|as published by the free software foundation)"),
    ("GPLversion21", r"(either )?version 2\.1 (of the license|as published by the free software foundation)"),
    ("GPLversion2", r"(either )?version 2 (of the license|as published by the free software foundation)"),
    ("AnyLater", r"(or )?(at your option )?any later version"),
    ("ApacheGrant2", r"licensed under the apache license version 2\.0"),
    ("ApacheUse", r"you may not use this file except in compliance with the license"),
    ("ApacheCopy", r"you may obtain a copy of the license at"),
    ("ApacheAsIs", r"distributed under the license is distributed on an as is basis"),
    ("MITgrant", r"(released|licensed|distributed|available) under the (terms of the )?mit license"),
    ("MITperm", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("MITnotice", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("MITwarranty", r"the software is provided as is without warranty of any kind express or implied"),
    ("BSDgrant3", r"(released|licensed) under the (3 clause|three clause|new|modified) bsd license"),
    ("BSDgrant2", r"(released|licensed) under the (2 clause|two clause|simplified) bsd license"),
    ("BSDpermit", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("BSDsource", r"redistributions of source code must retain the above copyright notice"),
    ("BSDbinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BSDname", r"neither the name of .*? may be used to endorse or promote products"),
    ("BSDwarranty", r"this software is provided by the copyright holders and contributors as is"),
    ("MPLgrant2", r"subject to the terms of the mozilla public license v(ersion)? ?\.? ?2\.0"),
    ("CCBYNCSA4", r"licensed under (a )?(cc by nc sa 4\.0|creative commons attribution noncommercial sharealike 4\.0)"),
    ("CCBYNC4", r"licensed under (a )?(cc by nc 4\.0|creative commons attribution noncommercial 4\.0)"),
    ("CCBYSA4", r"licensed under (a )?(cc by sa 4\.0|creative commons attribution sharealike 4\.0)"),
    ("CCBY4", r"licensed under (a )?(cc by 4\.0|creative commons attribution 4\.0)"),
    ("CC0", r"((licensed|released) under (the )?)?(cc0 1\.0|dedicated to the public domain)"),
    ("AllRights", r"\ball rights reserved$"),
    ("OtherGrant", r"(licensed|released) under "),
)
# Rules (licence, sequence of identifiers), in order.
RULES = (
    ("BSD-3-Clause", ("BSDpermit", "BSDsource", "BSDbinary", "BSDname", "BSDwarranty")),
    ("BSD-2-Clause", ("BSDpermit", "BSDsource", "BSDbinary", "BSDwarranty")),
    ("MIT", ("MITperm", "MITnotice", "MITwarranty")),
    ("Apache-2.0", ("ApacheGrant2", "ApacheUse", "ApacheCopy", "ApacheAsIs")),
    ("GPL-3.0-or-later", ("GPLredist", "GPLversion3", "AnyLater")),
    ("GPL-2.0-or-later", ("GPLredist", "GPLversion2", "AnyLater")),
    ("AGPL-3.0", ("AGPLredist", "GPLversion3", "AnyLater")),
    ("LGPL", ("LGPLredist", "GPLversion3", "AnyLater")),
    ("LGPL", ("LGPLredist", "GPLversion21", "AnyLater")),
    ("LGPL", ("LGPLredist", "GPLversion2", "AnyLater")),
    ("GPL-3.0-only", ("GPLredist", "GPLversion3")),
    ("GPL-2.0-only", ("GPLredist", "GPLversion2")),
    ("AGPL-3.0", ("AGPLredist", "GPLversion3")),
    ("LGPL", ("LGPLredist", "GPLversion3")),
    ("LGPL", ("LGPLredist", "GPLversion21")),
    ("LGPL", ("LGPLredist", "GPLversion2")),
    ("GPL", ("GPLredist",)),
    ("AGPL", ("AGPLredist",)),
    ("LGPL", ("LGPLredist",)),
    ("GPL-3.0-or-later", ("GPLgrant3", "AnyLater")),
    ("GPL-2.0-or-later", ("GPLgrant2", "AnyLater")),
    ("GPL-3.0-only", ("GPLgrant3",)),
    ("GPL-2.0-only", ("GPLgrant2",)),
    ("AGPL-3.0", ("AGPLgrant3",)),
    ("LGPL", ("LGPLgrant",)),
    ("Apache-2.0", ("ApacheGrant2",)),
    ("MIT", ("MITgrant",)),
    ("MIT", ("MITperm",)),
    ("BSD-3-Clause", ("BSDgrant3",)),
    ("BSD-2-Clause", ("BSDgrant2",)),
    ("MPL-2.0", ("MPLgrant2",)),
    ("CC-BY-NC-SA-4.0", ("CCBYNCSA4",)),
    ("CC-BY-NC-4.0", ("CCBYNC4",)),
    ("CC-BY-SA-4.0", ("CCBYSA4",)),
    ("CC-BY-4.0", ("CCBY4",)),
    ("CC0-1.0", ("CC0",)),
    ("MIT", ("SPDX-MIT",)),
    ("Apache-2.0", ("SPDX-Apache2",)),
    ("GPL-3.0", ("SPDX-GPL3",)),
    ("BSD-3-Clause", ("SPDX-BSD3",)),
    ("All-rights-reserved", ("AllRights",)),
)
#: Every sentence form has one of these, so texts without them are not cut.
TELLING = (
    r"license|licensed|released\W+under|distributed\W+under|copyright|redistribut|permission|warranty|rights\W+reserved"
    r"|any\W+later\W+version|cc0|public\W+domain|provided\W+by|promote\W+products"
)
SENTENCE_END = r"([.;!?])[\x20\x09-\x0D]+"
#: Two line ends with no letter or digit between them, in lower case and with ``\n`` alone.
BLANK_LINE = r"\n[^a-z0-9\n]*\n"


def normalise(sentence: Column) -> Column:
    """Words with one space between them, or one line end; runs of dots are read once."""
    plain = F.regexp_replace(F.lower(sentence), "[^a-z0-9.\n]+", " ")
    return F.regexp_replace(
        F.regexp_replace(plain, "(?<![ .])[ .]*+\n[ .]*+", "\n"), r"\A[ .\n]++|(?<![ .\n])[ .\n]++\z", ""
    )


def _form(form: str) -> str:
    return form.replace(" ", r"[ \n]")


ANY_FORM = "(?ms)" + "|".join(f"(?:{_form(form)})" for _, form in SENTENCES)


def form_id(found: Column) -> Column:
    """The identifier of the first form that is ``found`` as a whole."""
    name = F.lit(None).cast("string")
    for identifier, form in reversed(SENTENCES):
        name = F.when(found.rlike(rf"(?ms)\A(?:{_form(form)})\z"), F.lit(identifier)).otherwise(name)
    return name


def sentence_ids(plain: Column) -> Column:
    return F.transform(F.regexp_extract_all(plain, F.lit(ANY_FORM), F.lit(0)), form_id)


def identifiers(text: Column) -> Column:
    """The known sentences of a text in order."""
    lines = F.lower(F.regexp_replace(F.regexp_replace(text, "\r\n?", "\n"), SENTENCE_END, "$1\n\n"))
    telling = F.filter(F.split(lines, BLANK_LINE), lambda s: s.rlike(TELLING))
    ids = F.flatten(F.transform(telling, lambda s: sentence_ids(normalise(s))))
    none = F.array().cast("array<string>")
    return F.when(text.rlike(f"(?i){TELLING}"), ids).otherwise(none)


def apply_rules(ids: Column) -> Column:
    """(left, found): identifiers that no rule used, and the rules' licences in order."""
    rules = F.array(
        *[F.struct(F.lit(lic).alias("licence"), F.lit("|" + "|".join(seq) + "|").alias("seq")) for lic, seq in RULES]
    )
    # every identifier stands between bars of its own, so that a used sequence leaves its neighbours whole
    text = F.concat(F.lit("|"), F.array_join(ids, "|"), F.lit("|"))
    start = F.struct(text.alias("left"), F.array().cast("array<string>").alias("found"))

    def step(state, rule):
        hit = F.contains(state["left"], rule["seq"])
        return F.struct(
            F.when(hit, F.replace(F.replace(state["left"], rule["seq"], F.lit("|;|")), rule["seq"], F.lit("|;|")))
            .otherwise(state["left"])
            .alias("left"),
            F.when(hit & ~F.array_contains(state["found"], rule["licence"]), F.array_append(state["found"], rule["licence"]))
            .otherwise(state["found"])
            .alias("found"),
        )

    return F.aggregate(rules, start, step)


def scan(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds identifiers, licenses and left_over (all comma-joined) to the documents."""
    if bad := [c for c in docs.columns if c.lower().startswith("_lic_")]:
        raise ValueError(f"reserved column names: {bad}")
    names = [c for c in docs.columns if c not in ("identifiers", "licenses", "left_over")]
    cut = docs.select(*[F.col(f"`{c}`") for c in names], F.coalesce(identifiers(F.col(f"`{text_col}`")), F.array().cast("array<string>")).alias("_lic_ids"))
    ruled = cut.withColumn("_lic_state", F.when(F.size("_lic_ids") > 0, apply_rules(F.col("_lic_ids"))))
    left = F.filter(F.split(F.col("_lic_state.left"), "[|;]+"), lambda x: x != "")
    return ruled.select(
        *[F.col(f"`{c}`") for c in names],
        F.array_join("_lic_ids", ",").alias("identifiers"),
        F.coalesce(F.array_join("_lic_state.found", ","), F.lit("")).alias("licenses"),
        F.coalesce(F.array_join(left, ","), F.lit("")).alias("left_over"),
    )


def license_digest(docs: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text")).select("doc_id", "identifiers", "licenses", "left_over")
