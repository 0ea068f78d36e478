"""Licence scan by sentence rules, with DataFrame functions only.

A text's sentences are normalised and looked up among known licence sentences; the identifiers of
a document, in order, are then matched against ordered licence rules (longer and more specific
rules first), each match consuming its identifiers.  SPDX tags name their licences, one identifier
a name of the expression.  What is left over stays visible: a sentence with licence wording that is
not known is UNKNOWN.  Everything happens inside the row, so
there is no shuffle and no document, however long or often repeated, concerns another task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import free_name

#: A text without any of these has no licence sentence (each pattern below contains one).
STEMS = ("licen", "copyright", "rights reserved", "redistribut", "permission", "warrant", "public domain",
         "free software", "creative commons", "cc by-", "as is", "liable", "endorse", "of the mpl")

#: Known sentences: identifier and pattern, which a normalised sentence must contain; the first
#: that fits counts.  Fixed values: the wording of the public licences and of their usual notices.
SENTENCES = (
    ("ApacheAs", r"licensed under the apache license, version 2\.0 \(the \"?license\"?\)"),
    ("ApacheTitle", r"^apache license,?( version 2(\.0)?)?( january 2004)?$"),
    ("ApacheUrl", r"^<?https?://(www\.)?apache\.org/licenses/license-2\.0(\.txt|\.html)?>?$"),
    ("ApacheRef", r"(licensed|released|distributed|available) under (the )?(terms of )?(the )?apache( software)? license,? (version |v)?2(\.0)?\b"),
    ("ApacheCopy", r"obtain a copy of the license at"),
    ("ApacheSoftware", r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed"),
    ("ApacheSee", r"see the license for the specific language governing permissions"),
    ("MitRef", r"(licensed|released|distributed|available) under (the )?(terms of )?(the )?mit license\b"),
    ("MitTitle", r"^(the )?(mit|x11|expat) license( \((mit|x11|expat)\))?$"),
    ("MitGrant", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MitNotice", r"above copyright notice and this permission notice (shall|must) be included in all copies"),
    ("MitAsIs", r"the software is provided \"as is\", without warranty of any kind"),
    ("MitLiable", r"in no event shall the authors or copyright holders be liable"),
    ("IscTitle", r"^(the )?isc license( \(isc\))?$"),
    ("IscGrant", r"permission to use, copy, modify, and(/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("IscAsIs", r"the software is provided \"as is\" and the author disclaims all warranties"),
    ("IscLiable", r"in no event shall the author be liable"),
    ("BsdTitle", r"^(the )?(new |modified |simplified )?(bsd|[23]-clause bsd|bsd [23]-clause)( \"?(new|revised|simplified)\"?( or \"?(new|revised|simplified)\"?)?)? license$"),
    ("BsdGrant", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BsdSource", r"redistributions of source code must retain the above copyright notice"),
    ("BsdBinary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("BsdEndorse", r"neither the names? of .* (may|can) be used to endorse or promote products"),
    ("BsdAsIs", r"this software is provided by .* \"?as is\"? and any express or implied warranties"),
    ("BsdLiable", r"in no event shall .* be liable for any direct, indirect, incidental"),
    ("BsdRef", r"(licensed|released|distributed|available) under (the )?(terms of )?(the )?(new |modified |simplified |[23]-clause )?bsd( [23]-clause)?( style)? license\b"),
    ("GplWarranty", r"distributed in the hope that (it|they) will be useful,? but without any warranty"),
    ("GplDetails", r"see the gnu (affero |lesser |library )?general public license for more details"),
    ("GplCopy", r"you should have received a copy of the gnu (affero |lesser |library )?general public license"),
    ("GnuUrl", r"^(if not, )?(see|visit) <?https?://(www\.)?gnu\.org/licenses"),
    ("AgplFree3Plus", r"gnu affero general public license as published by the free software foundation[,;]? either version 3 of the license, or \(?at your option"),
    ("LgplFree3Plus", r"gnu lesser general public license as published by the free software foundation[,;]? either version 3 of the license, or \(?at your option"),
    ("LgplFree21Plus", r"gnu lesser general public license as published by the free software foundation[,;]? either version 2\.1 of the license, or \(?at your option"),
    ("LgplFree2Plus", r"gnu (lesser|library) general public license as published by the free software foundation[,;]? either version 2 of the license, or \(?at your option"),
    ("GplFree3Plus", r"gnu general public license as published by the free software foundation[,;]? either version 3 of the license, or \(?at your option"),
    ("GplFree2Plus", r"gnu general public license as published by the free software foundation[,;]? either version 2 of the license, or \(?at your option"),
    ("AgplRef", r"gnu affero general public license,? (as published|(version|v) ?3)"),
    ("LgplRef3", r"gnu lesser general public license,? .*(version|v) ?3"),
    ("LgplRef21", r"gnu lesser general public license,? .*(version|v) ?2\.1"),
    ("LgplRef2", r"gnu (lesser|library) general public license,? .*(version|v) ?2"),
    ("LgplRef", r"gnu (lesser|library) general public license"),
    ("GplRef3", r"gnu general public license,? .*(version|v) ?3"),
    ("GplRef2", r"gnu general public license,? .*(version|v) ?2"),
    ("GplRef", r"gnu general public license"),
    ("MplForm", r"subject to the terms of the mozilla public license, v"),
    ("MplCopy", r"if a copy of the mpl was not distributed with this file"),
    ("CcByNcSa", r"(cc by-nc-sa|creative commons attribution-noncommercial-sharealike)"),
    ("CcByNcNd", r"(cc by-nc-nd|creative commons attribution-noncommercial-noderiv)"),
    ("CcByNc", r"(licen[a-z]+ .*\bcc by-nc|creative commons attribution-noncommercial)"),
    ("CcBySa", r"(licen[a-z]+ .*\bcc by-sa|creative commons attribution-sharealike)"),
    ("CcByNd", r"(licen[a-z]+ .*\bcc by-nd|creative commons attribution-noderiv)"),
    ("CcBy", r"(licen[a-z]+ .*\bcc by\b|creative commons attribution)"),
    ("Cc0", r"(licen[a-z]+ .*\bcc0|creative commons zero|dedicat[a-z]+ .*to the public domain)"),
    ("Unlicense", r"this is free and unencumbered software released into the public domain"),
    ("PublicDomain", r"(in|into|to) the public domain"),
    ("AllRights", r"all rights reserved"),
    ("Copyright", r"copyright( \(c\)| ©)? .*(19|20)[0-9][0-9]|copyright \(c\)"),
)

_GNU = ("GplWarranty?", "GplDetails?", "GplCopy?", "GnuUrl?")
_BSD = ("BsdTitle?", "Copyright?", "AllRights?", "BsdGrant", "BsdSource", "BsdBinary")

#: Ordered rules: licence and the identifiers it needs, next to each other ("?": may be missing).
RULES = (
    ("Apache-2.0", ("ApacheTitle?", "Copyright?", "ApacheAs", "ApacheCopy?", "ApacheUrl?", "ApacheSoftware?", "ApacheSee?")),
    ("MIT", ("MitTitle?", "Copyright?", "MitGrant", "MitNotice", "MitAsIs", "MitLiable?")),
    ("ISC", ("IscTitle?", "Copyright?", "IscGrant", "IscAsIs", "IscLiable?")),
    ("BSD-3-Clause", (*_BSD, "BsdEndorse", "BsdAsIs", "BsdLiable")),
    ("BSD-2-Clause", (*_BSD, "BsdAsIs", "BsdLiable")),
    ("AGPL-3.0-or-later", ("AgplFree3Plus", *_GNU)),
    ("LGPL-3.0-or-later", ("LgplFree3Plus", *_GNU)),
    ("LGPL-2.1-or-later", ("LgplFree21Plus", *_GNU)),
    ("LGPL-2.0-or-later", ("LgplFree2Plus", *_GNU)),
    ("GPL-3.0-or-later", ("GplFree3Plus", *_GNU)),
    ("GPL-2.0-or-later", ("GplFree2Plus", *_GNU)),
    ("MPL-2.0", ("MplForm", "MplCopy?")),
    ("Apache-2.0", ("ApacheRef",)),
    ("Apache-2.0", ("ApacheTitle",)),
    ("MIT", ("MitRef",)),
    ("MIT", ("MitTitle",)),
    ("ISC", ("IscTitle",)),
    ("BSD", ("BsdRef",)),
    ("BSD", ("BsdTitle",)),
    ("AGPL-3.0", ("AgplRef", *_GNU)),
    ("LGPL-3.0", ("LgplRef3", *_GNU)),
    ("LGPL-2.1", ("LgplRef21", *_GNU)),
    ("LGPL-2.0", ("LgplRef2", *_GNU)),
    ("LGPL", ("LgplRef",)),
    ("GPL-3.0", ("GplRef3", *_GNU)),
    ("GPL-2.0", ("GplRef2", *_GNU)),
    ("GPL", ("GplRef",)),
    ("CC-BY-NC-SA", ("CcByNcSa",)),
    ("CC-BY-NC-ND", ("CcByNcNd",)),
    ("CC-BY-NC", ("CcByNc",)),
    ("CC-BY-SA", ("CcBySa",)),
    ("CC-BY-ND", ("CcByNd",)),
    ("CC-BY", ("CcBy",)),
    ("CC0-1.0", ("Cc0",)),
    ("Unlicense", ("Unlicense",)),
    ("Public-Domain", ("PublicDomain",)),
    ("SPDX", ("SpdxOther",)),
    ("All-Rights-Reserved", ("Copyright?", "AllRights")),
)


def sequence(needs: tuple[str, ...]) -> str:
    """Pattern of a rule over the identifiers "[A][B]..."."""
    return "".join(rf"(\[{n[:-1]}\])?" if n.endswith("?") else rf"\[{n}\]" for n in needs)


#: Names of SPDX tags (lower case) and the licence each stands for; other names are SpdxOther.
#: Identifiers of the SPDX list.
SPDX = {
    "mit": "MIT", "isc": "ISC", "apache-2.0": "Apache-2.0", "bsd-2-clause": "BSD-2-Clause", "bsd-3-clause": "BSD-3-Clause",
    "gpl-2.0": "GPL-2.0", "gpl-2.0-only": "GPL-2.0-only", "gpl-2.0+": "GPL-2.0-or-later", "gpl-2.0-or-later": "GPL-2.0-or-later",
    "gpl-3.0": "GPL-3.0", "gpl-3.0-only": "GPL-3.0-only", "gpl-3.0+": "GPL-3.0-or-later", "gpl-3.0-or-later": "GPL-3.0-or-later",
    "lgpl-2.0": "LGPL-2.0", "lgpl-2.0-only": "LGPL-2.0-only", "lgpl-2.0+": "LGPL-2.0-or-later", "lgpl-2.0-or-later": "LGPL-2.0-or-later",
    "lgpl-2.1": "LGPL-2.1", "lgpl-2.1-only": "LGPL-2.1-only", "lgpl-2.1+": "LGPL-2.1-or-later", "lgpl-2.1-or-later": "LGPL-2.1-or-later",
    "lgpl-3.0": "LGPL-3.0", "lgpl-3.0-only": "LGPL-3.0-only", "lgpl-3.0+": "LGPL-3.0-or-later", "lgpl-3.0-or-later": "LGPL-3.0-or-later",
    "agpl-3.0": "AGPL-3.0", "agpl-3.0-only": "AGPL-3.0-only", "agpl-3.0+": "AGPL-3.0-or-later", "agpl-3.0-or-later": "AGPL-3.0-or-later",
    "mpl-2.0": "MPL-2.0", "unlicense": "Unlicense", "cc0-1.0": "CC0-1.0", "cc-by-4.0": "CC-BY", "cc-by-sa-4.0": "CC-BY-SA",
    "cc-by-nd-4.0": "CC-BY-ND", "cc-by-nc-4.0": "CC-BY-NC", "cc-by-nc-sa-4.0": "CC-BY-NC-SA", "cc-by-nc-nd-4.0": "CC-BY-NC-ND",
}
_NAME = "[( ]*[a-z0-9][a-z0-9.+-]*[) ]*"
#: A tag with its expression; an exception (after "with") is no licence; names of an expression.
TAG = f"spdx-license-identifier={_NAME}((and|or|with) +{_NAME})*"
EXCEPTION, NAMES = "(spdx-license-identifier=| with +[a-z0-9.+-]+| and | or |[( )])", "[a-z0-9][a-z0-9.+-]*"
#: Wording by which a sentence that is not known counts as one about licences.
WORDING = "licens|copyright|redistribut|all rights reserved"

#: Normalisation, in order: (pattern, replacement) over lower-case text.
CLEANING = (
    (r"[“”„«»`]|''", '"'),
    (r"[‘’]", "'"),
    (r"licence", "license"),
    (r"spdx-license-identifier:[ \t]*", "spdx-license-identifier="),
    (r"(^|\n)[ \t]*(//+|/?\*+/?|#+|;+|--+|%+|dnl )", "\n"),  # comment marks at the start of lines
    (r"\n[ \t\r]*\n", ". "),                                 # an empty line ends a sentence
    (r"[\t\n\x0B\f\r ]+", " "),
    (r"[.!?:;]*\"? *\*/ *", "\x01"),                          # the end of a comment, too
    (r"[.!?]+\"?( |$)", "\x01"),                             # where a sentence ends
)


#: What may stand between two words of a text that CLEANING parts by one space: white space and
#: comment marks (their characters, so that runs of any length match without recursion).
GAP = r"[\t\n\x0B\f\r /*#;%dnl-]+"


def has_stem(text: Column) -> Column:
    """False only for texts without a stem in their normalised sentences: on the raw text, the words of
    a stem may be parted by line breaks, several spaces or comment marks."""
    low = F.lower(text)
    out = F.lit(False)
    for s in STEMS:
        words = s.split(" ")
        fits = F.contains(low, F.lit(words[-1]))
        out = out | (fits & F.rlike(low, F.lit(GAP.join(words))) if len(words) > 1 else fits)
    return out


def sentences(text: Column) -> Column:
    """Array of normalised sentences."""
    out = F.lower(text)
    for pattern, by in CLEANING:
        out = F.regexp_replace(out, pattern, by)
    return F.split(out, "\x01")


def identifier(sentence: Column) -> Column:
    """Identifier of a normalised sentence: known, UNKNOWN if it has licence wording, else null."""
    plain = F.trim(F.regexp_replace(sentence, "[ :;,-]+$", ""))
    out = F.when(F.rlike(plain, F.lit(SENTENCES[0][1])), SENTENCES[0][0])
    for name, pattern in SENTENCES[1:]:
        out = out.when(F.rlike(plain, F.lit(pattern)), name)
    out = out.when(F.rlike(plain, F.lit(WORDING)), "UNKNOWN")
    return F.when(F.rlike(plain, F.lit("|".join(STEMS))), out)


def tagged(sentence: Column) -> Column:
    """Identifiers of the licences that a sentence's SPDX tags name."""
    known = F.create_map(*[F.lit(x) for kv in SPDX.items() for x in kv])
    name = lambda n: F.coalesce(F.concat(F.lit("Spdx."), F.try_element_at(known, F.regexp_replace(n, r"[.-]+$", ""))), F.lit("SpdxOther"))
    names = lambda tag: F.regexp_extract_all(F.regexp_replace(tag, EXCEPTION, " "), F.lit(NAMES), F.lit(0))
    return F.transform(F.flatten(F.transform(F.regexp_extract_all(sentence, F.lit(TAG), F.lit(0)), names)), name)


def identifiers(sentence: Column) -> Column:
    """Array of the identifiers of a sentence: those of its tags, then that of the rest."""
    rest = F.array_compact(F.array(identifier(F.regexp_replace(sentence, TAG, ""))))
    return F.when(F.contains(sentence, F.lit("spdx-license-identifier=")), F.concat(tagged(sentence), rest)).otherwise(
        F.array_compact(F.array(identifier(sentence))))


def apply_rules(found: Column) -> Column:
    """The identifiers "[A][B]..." with every match of a rule replaced by "{licence}"."""
    found = F.regexp_replace(found, r"\[Spdx\.([^\]]*)\]", "{$1}")
    for licence, needs in RULES:
        found = F.regexp_replace(found, sequence(needs), "{" + licence + "}")
    return found


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with sentence_ids (array, in order), licenses (array, in order of first mention), n_unknown
    (long: sentences that sound like a licence and are not known) and n_unused (long: known
    sentences that no rule took) and verdict (none, one, several or unknown), replaced if there.

    Row by row: null ids and repeated rows stay; a null or empty text has no sentences and verdict
    none; whole texts of any length are read."""
    t = F.coalesce(F.col(text), F.lit(""))
    empty = F.array().cast("array<string>")
    ids = F.when(has_stem(t), F.flatten(F.transform(sentences(t), identifiers))).otherwise(empty)
    # each step is a projection of its own, so that the array is computed once and not inlined
    seq, left, lic = (free_name(docs, n) for n in ("__ids", "__left", "__lic"))
    out = docs.withColumn(seq, ids)
    out = out.withColumn(left, F.when(F.size(seq) > 0, apply_rules(
        F.concat(F.lit("["), F.array_join(seq, "]["), F.lit("]")))).otherwise(F.lit("")))
    out = out.withColumn(lic, F.array_distinct(F.regexp_extract_all(left, F.lit(r"\{([^}]*)\}"), F.lit(1))))
    out = out.withColumns({
        "sentence_ids": F.col(seq), "licenses": F.col(lic),
        "n_unknown": F.size(F.filter(seq, lambda x: x == "UNKNOWN")).cast("long"),
        "n_unused": F.size(F.regexp_extract_all(left, F.lit(r"\[([A-Z][a-z0-9][A-Za-z0-9]*)\]"), F.lit(1))).cast("long")})
    return out.withColumn("verdict", F.when(F.size(lic) > 1, "several").when(F.size(lic) == 1, "one")
                          .when(F.size(seq) > 0, "unknown").otherwise("none")).drop(seq, left, lic)


def sql(documents: str = "documents") -> str:
    """The same scan in SQL (RE2 patterns) over the sentences of every text, without the look for stems."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    clean = "lower(coalesce(text, ''))"
    for pattern, by in CLEANING:
        clean = f"regexp_replace({clean}, {q(pattern)}, {'chr(1)' if by == chr(1) else 'chr(10)' if by == chr(10) else q(by)}, 'g')"
    case = "CASE " + " ".join(f"WHEN regexp_matches(p, {q(p)}) THEN {q(n)}" for n, p in SENTENCES) + \
        f" WHEN regexp_matches(p, {q(WORDING)}) THEN 'UNKNOWN' END"
    spdx = "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in SPDX.items()) + "}"
    left = r"regexp_replace('[' || array_to_string(ids, '][') || ']', '\[Spdx\.([^\]]*)\]', '{\1}', 'g')"
    for licence, needs in RULES:
        left = f"regexp_replace({left}, {q(sequence(needs))}, {q('{' + licence + '}')}, 'g')"
    return f"""
WITH s0 AS (SELECT doc_id, row_number() OVER () AS r, string_split({clean}, chr(1)) AS ss FROM {documents}),
     s1 AS (SELECT doc_id, r, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM s0),
     s2 AS (SELECT *, regexp_extract_all(s, {q(TAG)}) AS tags,
                   trim(regexp_replace(regexp_replace(s, {q(TAG)}, '', 'g'), '[ :;,-]+$', '')) AS p FROM s1),
     s3 AS (SELECT *, list_transform(flatten(list_transform(tags, lambda t: regexp_extract_all(regexp_replace(t, {q(EXCEPTION)}, ' ', 'g'), {q(NAMES)}))),
                   lambda n: coalesce('Spdx.' || ({spdx})[regexp_replace(n, '[.-]+$', '')], 'SpdxOther')) AS named, {case} AS id FROM s2),
     a AS (SELECT r, any_value(doc_id) AS doc_id,
                  flatten(list(list_concat(named, CASE WHEN id IS NULL THEN [] ELSE [id] END) ORDER BY i)) AS ids FROM s3 GROUP BY r),
     b AS (SELECT doc_id, ids, CASE WHEN len(ids) > 0 THEN {left} ELSE '' END AS rest FROM a),
     c AS (SELECT *, regexp_extract_all(rest, '\\{{([^}}]*)\\}}', 1) AS l FROM b),
     d AS (SELECT *, list_filter(l, lambda x, i: list_position(l, x) = i) AS lic FROM c)
SELECT doc_id, array_to_string(ids, ',') AS sentence_ids, array_to_string(lic, ',') AS licenses,
       CAST(len(list_filter(ids, lambda x: x = 'UNKNOWN')) AS BIGINT) AS n_unknown,
       CAST(len(regexp_extract_all(rest, '\\[([A-Z][a-z0-9][A-Za-z0-9]*)\\]', 1)) AS BIGINT) AS n_unused,
       CASE WHEN len(lic) > 1 THEN 'several' WHEN len(lic) = 1 THEN 'one' WHEN len(ids) > 0 THEN 'unknown'
            ELSE 'none' END AS verdict FROM d"""
