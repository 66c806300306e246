"""Licence scans by sentence rules.

A text is cut into sentences, each normalised sentence is looked up among known licence sentences (some have slots that
take a holder's or a licence's name), and the sequence of their identifiers is matched against ordered rules, longest
first; what a rule matches is used up. Between the sentences of one rule only white space, copyright lines, numbers and headings of up to
three words may stand: any other sentence parts what stands before from what stands behind. One that merely
looks like a licence counts as UNKNOWN, and so does a known sentence that no rule has used up, unless it belongs to a licence that was found. A sentence or SPDX line may
name several licences (AND, OR); an exception (WITH) leaves the licence that it is one to. Everything is a DataFrame expression; only texts that hold a telling word are cut.

A new sentence begins after a full stop, semicolon, question or exclamation mark before white
space, after a colon that ends a line, after an empty line, at a line that starts like a known notice, and after an SPDX line; other line ends join. Case,
marks and white space don't count. Null and empty texts have no sentence, very long ones are cut like others; each row, repeated or not,
gives one row, whatever its id; an empty table gives an empty result. Further columns, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Well-known licence sentences, normalised, by identifier.
SENTENCES = {
    "ApacheName": ["licensed under the apache license version 2.0 the license", "licensed under the apache license version 2.0", "released under the apache license version 2.0", "spdx license identifier apache 2.0"],
    "ApacheUse": ["licensed under the apache license version 2.0 the license you may not use this file except in compliance with the license", "you may not use this file except in compliance with the license"],
    "ApacheCopy": ["you may obtain a copy of the license at"],
    "ApacheUrl": ["http www.apache.org licenses license 2.0", "https www.apache.org licenses license 2.0"],
    "ApacheAsIs": ["unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "ApacheSee": ["see the license for the specific language governing permissions and limitations under the license"],
    "MitName": ["released under the mit license", "licensed under the mit license", "this project is licensed under the mit license", "spdx license identifier mit"],
    "MitGrant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "MitNotice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "MitAsIs": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "MitLiable": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"],
    "BsdGrant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "BsdSource": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "BsdBinary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "Gpl3Name": ["this work is licensed under the gnu general public license version 3", "licensed under the gnu general public license version 3", "spdx license identifier gpl 3.0 only"],
    "Gpl3Later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", "spdx license identifier gpl 3.0 or later"],
    "Gpl2Later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"],
    "Lgpl21Later": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2.1 of the license or at your option any later version"],
    "Lgpl3Later": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "Agpl3Later": ["this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"],
    "GplYou": ["you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"],
    "LgplYou": ["you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"],
    "AgplYou": ["you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"],
    "Either2": ["either version 2 of the license or at your option any later version"],
    "Either21": ["either version 2.1 of the license or at your option any later version"],
    "Either3": ["either version 3 of the license or at your option any later version"],
    "FreeSoftware": ["this program is free software", "this library is free software"],
    "GplWarranty": ["this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose", "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"],
    "GplHope": ["this program is distributed in the hope that it will be useful but without any warranty", "this library is distributed in the hope that it will be useful but without any warranty"],
    "GplEven": ["without even the implied warranty of merchantability or fitness for a particular purpose"],
    "GplSee": ["see the gnu general public license for more details", "see the gnu lesser general public license for more details", "see the gnu affero general public license for more details"],
    "IscGrant": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "IscAsIs": ["the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"],
    "IscLiable": ["in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"],
    "ZlibAsIs": ["this software is provided as is without any express or implied warranty"],
    "ZlibLiable": ["in no event will the authors be held liable for any damages arising from the use of this software"],
    "ZlibGrant": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "BoostGrant": ["permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"],
    "EplGrant": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which is available at https www.eclipse.org legal epl 2.0"],
    "CcByNc4": ["licensed under cc by nc 4.0", "this work is licensed under cc by nc 4.0", "this work is licensed under a creative commons attribution noncommercial 4.0 international license"],
    "CcBy4": ["licensed under cc by 4.0", "this work is licensed under a creative commons attribution 4.0 international license"],
    "Mpl2": ["this source code form is subject to the terms of the mozilla public license v 2.0"],
    "MplCopy": ["if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org mpl 2.0", "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla.org mpl 2.0"],
    "Unlicense": ["this is free and unencumbered software released into the public domain"],
    "Rights": ["all rights reserved"],
}
#: Licence sentences with a slot for a holder's name.
SLOTS = {
    "BsdNames": "neither the name of .{1,80} nor the names of (its|their) contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "BsdAsIs": "this software is provided by .{1,80} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "BsdLiable": "in no event shall .{1,80} be liable for any direct indirect incidental special exemplary or consequential damages .{1,600}",
    **{
        f"{name}{last}": ".{1,80} is free software you can redistribute it and or modify it under the terms of the gnu " + kind + "general public license as published by the free software foundation " + tail
        for name, kind, versions in (("Gpl", "", ("2", "3")), ("Lgpl", "lesser ", ("2.1", "3")), ("Agpl", "affero ", ("3",)))
        for v in versions
        for last, tail in ((v.replace(".", "") + "Later", f"either version {v} of the license or at your option any later version"), (v.replace(".", "") + "Only", f"(either )?version {v} of the license"))
    },
    **{
        f"{name}{v.replace('.', '')}Only2": "(.{1,80} is free software )?you can redistribute it and or modify it under the terms of version " + v + " of the gnu " + kind + "general public license( as published by the free software foundation)?"
        for name, kind, versions in (("Gpl", "", ("2", "3")), ("Lgpl", "lesser ", ("2.1", "3")), ("Agpl", "affero ", ("3",)))
        for v in versions
    },
    "FreeSoftware": ".{1,80} is free software",
    "GplWarranty": ".{1,80} is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "GplHope": ".{1,80} is distributed in the hope that it will be useful but without any warranty",
    "Cc0Waiver": "to the extent possible under law .{1,80} has waived all copyright and related or neighboring rights to .{1,80}",
}
#: Names that a sentence "(licensed|released|distributed|available) under ..." or an SPDX line may give, and what they name.
NAMES = {
    "Apache-2.0": ["apache license version 2.0", "apache license 2.0", "apache 2.0", "apache 2.0 license"],
    "MIT": ["mit license", "mit", "expat license"],
    "BSD-2-Clause": ["bsd 2 clause license", "bsd 2 clause", "simplified bsd license"],
    "BSD-3-Clause": ["bsd 3 clause license", "bsd 3 clause", "new bsd license", "modified bsd license"],
    "GPL-2.0-only": ["gnu general public license version 2", "gnu general public license v2.0", "gnu gpl version 2", "gpl v2", "gpl 2.0", "gpl 2.0 only"],
    "GPL-2.0-or-later": ["gnu general public license version 2 or later", "gpl 2.0 or later"],
    "GPL-3.0-only": ["gnu general public license version 3", "gnu general public license v3.0", "gnu gpl version 3", "gpl v3", "gpl 3.0", "gpl 3.0 only"],
    "GPL-3.0-or-later": ["gnu general public license version 3 or later", "gpl 3.0 or later"],
    "LGPL-2.1-only": ["gnu lesser general public license version 2.1", "gnu lgpl version 2.1", "lgpl 2.1", "lgpl 2.1 only"],
    "LGPL-2.1-or-later": ["gnu lesser general public license version 2.1 or later", "lgpl 2.1 or later"],
    "LGPL-3.0-only": ["gnu lesser general public license version 3", "gnu lgpl version 3", "lgpl 3.0", "lgpl 3.0 only"],
    "LGPL-3.0-or-later": ["gnu lesser general public license version 3 or later", "lgpl 3.0 or later"],
    "AGPL-3.0-only": ["gnu affero general public license version 3", "gnu agpl version 3", "agpl 3.0", "agpl 3.0 only"],
    "AGPL-3.0-or-later": ["gnu affero general public license version 3 or later", "agpl 3.0 or later"],
    "ISC": ["isc license", "isc"],
    "Zlib": ["zlib license", "zlib"],
    "BSL-1.0": ["boost software license version 1.0", "bsl 1.0"],
    "MPL-2.0": ["mozilla public license version 2.0", "mozilla public license 2.0", "mpl 2.0"],
    "EPL-2.0": ["eclipse public license version 2.0", "eclipse public license 2.0", "epl 2.0"],
    "CC0-1.0": ["cc0 1.0", "cc0 1.0 universal", "creative commons zero v1.0 universal"],
    "CC-BY-4.0": ["cc by 4.0", "creative commons attribution 4.0 international license"],
    "CC-BY-SA-4.0": ["cc by sa 4.0", "creative commons attribution sharealike 4.0 international license", "creative commons attribution share alike 4.0 international license"],
    "CC-BY-NC-4.0": ["cc by nc 4.0", "creative commons attribution noncommercial 4.0 international license"],
    "CC-BY-ND-4.0": ["cc by nd 4.0", "creative commons attribution noderivatives 4.0 international license"],
    "CC-BY-NC-SA-4.0": ["cc by nc sa 4.0", "creative commons attribution noncommercial sharealike 4.0 international license"],
    "Unlicense": ["unlicense", "the unlicense"],
}
#: Licences and the sentence sequences that state them.
RULES = [
    ("Apache-2.0", ["ApacheName", "ApacheUse", "ApacheCopy", "ApacheUrl", "ApacheAsIs", "ApacheSee"]),
    ("Apache-2.0", ["ApacheUse", "ApacheCopy", "ApacheUrl", "ApacheAsIs", "ApacheSee"]),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdNames", "BsdAsIs", "BsdLiable"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdAsIs", "BsdLiable"]),
    ("MIT", ["MitGrant", "MitNotice", "MitAsIs", "MitLiable"]),
    ("BSD-3-Clause", ["BsdGrant", "BsdSource", "BsdBinary", "BsdNames"]),
    ("BSD-2-Clause", ["BsdGrant", "BsdSource", "BsdBinary"]),
    ("GPL-3.0-or-later", ["Gpl3Later", "GplWarranty", "GplSee"]),
    ("GPL-2.0-or-later", ["Gpl2Later", "GplWarranty", "GplSee"]),
    ("LGPL-2.1-or-later", ["Lgpl21Later", "GplWarranty", "GplSee"]),
    ("LGPL-3.0-or-later", ["Lgpl3Later", "GplWarranty", "GplSee"]),
    ("AGPL-3.0-or-later", ["Agpl3Later", "GplWarranty", "GplSee"]),
    ("GPL-2.0-or-later", ["FreeSoftware", "GplYou", "Either2"]),
    ("GPL-3.0-or-later", ["FreeSoftware", "GplYou", "Either3"]),
    ("LGPL-2.1-or-later", ["FreeSoftware", "LgplYou", "Either21"]),
    ("LGPL-3.0-or-later", ["FreeSoftware", "LgplYou", "Either3"]),
    ("AGPL-3.0-or-later", ["FreeSoftware", "AgplYou", "Either3"]),
    ("ISC", ["IscGrant", "IscAsIs", "IscLiable"]),
    ("Zlib", ["ZlibAsIs", "ZlibLiable", "ZlibGrant"]),
    ("MPL-2.0", ["Mpl2", "MplCopy"]),
    *((f"{name.upper()}-{v}-only", [f"{name}{v.removesuffix('.0').replace('.', '')}{kind}"]) for name, v in (("Gpl", "2.0"), ("Gpl", "3.0"), ("Lgpl", "2.1"), ("Lgpl", "3.0"), ("Agpl", "3.0")) for kind in ("Only", "Only2")),
    ("GPL-3.0-or-later", ["Gpl3Later"]),
    ("GPL-2.0-or-later", ["Gpl2Later"]),
    ("LGPL-2.1-or-later", ["Lgpl21Later"]),
    ("LGPL-3.0-or-later", ["Lgpl3Later"]),
    ("AGPL-3.0-or-later", ["Agpl3Later"]),
    ("Apache-2.0", ["ApacheName"]),
    ("MIT", ["MitName"]),
    ("GPL-3.0-only", ["Gpl3Name"]),
    ("BSL-1.0", ["BoostGrant"]),
    ("EPL-2.0", ["EplGrant"]),
    ("CC0-1.0", ["Cc0Waiver"]),
    ("CC-BY-NC-4.0", ["CcByNc4"]),
    ("CC-BY-4.0", ["CcBy4"]),
    ("MPL-2.0", ["Mpl2"]),
    ("Unlicense", ["Unlicense"]),
    ("All rights reserved", ["Rights"]),
]
for _name, _v in (("GPL", "2.0"), ("GPL", "3.0"), ("LGPL", "2.1"), ("LGPL", "3.0"), ("AGPL", "3.0")):
    _kind = {"GPL": "", "LGPL": "lesser ", "AGPL": "affero "}[_name]
    NAMES[f"{_name}-{_v}-only"].append(f"version {_v.removesuffix('.0')} of the gnu {_kind}general public license")
    NAMES[f"{_name}-{_v}-or-later"].append(f"version {_v.removesuffix('.0')} or later of the gnu {_kind}general public license")
for _kind, _said in (("BY", ""), ("BY-SA", " sharealike"), ("BY-SA", " share alike"), ("BY-NC", " noncommercial"), ("BY-ND", " noderivatives"), ("BY-ND", " noderivs"), ("BY-NC-SA", " noncommercial sharealike"), ("BY-NC-ND", " noncommercial noderivatives"), ("BY-NC-ND", " noncommercial noderivs")):
    for _v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        _own = NAMES.setdefault(f"CC-{_kind}-{_v}", [])
        for _x in (f"cc {_kind.lower().replace('-', ' ')} {_v}", *(f"creative commons attribution{_said} {_v}{_tail} license" for _tail in ("", " international", " unported", " generic"))):
            if _x not in _own:
                _own.append(_x)
NAMED = r"^(?:.{0,60} )?(?:licen[cs]ed|released|distributed|available) under (?:either of |either )?(?:the terms of )?(?:the |an? )?(.+)$|^spdx licen[cs]e identifier (.+)$"
#: What an expression's licences are parted by, and what stands before and behind a name.
PARTED, BEFORE, BEHIND = " (?:or|and) ", "^(?:the terms of )?(?:the |an? )", " with .*$"
#: What may stand between the sentences of one rule.
BETWEEN = r"^(?:copyright .*|c [0-9]{4} .*|[0-9a-z]|[0-9.]+|[^ ]+(?: [^ ]+){0,2})$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TELLING = r"(?i)licen[cs]e|spdx|redistribut|permission|warrant|rights reserved|public domain|copyright|released under"
STARTS = r"(?i)\n[ \t*/#>-]*(licensed under|released under|this work is licensed|this project is licensed|this program is|permission is hereby|redistribution|neither the name|this source code form|this is free and|this software is|this library is|this work is|in no event|permission to use|permission is granted|to the extent|all rights reserved|spdx)"
SPDX_LINE = r"(?i)(spdx-licen[cs]e-identifier:[^\n]*)\n"
ENDS = r"[.;!?]+[ \t\r\n]|:[ \t\r]*\n|\n[ \t\r]*\n"
NOT_WORD = r"[^a-z0-9.]+"
SUSPECT = r"(^| )(licen[cs]ed?|licensing|permission|warranty|warranties|redistributions?)( |$)"
BREAK = "\x1e"


def ordered_rules() -> list[tuple[str, list[str]]]:
    return sorted(RULES, key=lambda r: -len(r[1]))


def sentences(text: Column) -> Column:
    """Normalised sentences."""
    t = F.concat(F.lit("\n"), text, F.lit("\n"))
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, STARTS, BREAK + "$1"), SPDX_LINE, f"$1{BREAK}"), ENDS, BREAK)
    t = F.regexp_replace(F.translate(t, UPPER, LOWER), r"[^a-z0-9.\x1e]+", " ")
    return F.filter(F.transform(F.split(t, BREAK), lambda x: F.regexp_replace(x, r"^[ .]+|[ .]+$", "")), lambda x: x != "")


def named(x: Column) -> Column:
    """The licences that a sentence names in its slot, joined by bars; null if none. "Or later" is part of a name."""
    known = F.create_map(*[F.lit(y) for spdx, names in NAMES.items() for n in names for y in (n, spdx)])
    said = F.replace(F.concat(F.regexp_extract(x, NAMED, 1), F.regexp_extract(x, NAMED, 2)), F.lit(" or later"), F.lit("#later"))
    each = F.transform(F.split(said, PARTED), lambda y: F.try_element_at(known, F.regexp_replace(F.regexp_replace(F.replace(y, F.lit("#later"), F.lit(" or later")), BEFORE, ""), BEHIND, "")))
    found = F.array_distinct(F.array_compact(each))
    return F.when(F.size(found) > 0, F.array_join(found, "|"))


def families() -> dict[str, list[str]]:
    """Each sentence's licences."""
    out: dict[str, list[str]] = {}
    for spdx, ids in RULES:
        for i in ids:
            if spdx not in out.setdefault(i, []):
                out[i].append(spdx)
    return out


def tokens(text: Column) -> Column:
    """Identifiers of the text's licence sentences in order; UNKNOWN, and OTHER where a foreign sentence parts them."""
    known = F.create_map(*[F.lit(y) for name, says in SENTENCES.items() for s in says for y in (s, name)])

    def token(x: Column) -> Column:
        slot = F.lit(None).cast("string")
        for name, said in reversed(SLOTS.items()):
            slot = F.when(x.rlike(f"^{said}$"), F.lit(name)).otherwise(slot)
        name = F.concat(F.lit("Name:"), named(x))
        other = F.when(x.rlike(SUSPECT), F.lit("UNKNOWN")).when(~x.rlike(BETWEEN), F.lit("OTHER"))
        return F.coalesce(F.try_element_at(known, x), slot, name, other)

    return F.array_compact(F.transform(sentences(text), token))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_sentences (known ones), n_unknown (known ones of unfinished rules among them), licenses (distinct, those of rules in their order, then those only named; joined by commas)."""
    own = F.when(F.col("text").rlike(TELLING), tokens(F.col("text"))).otherwise(F.array().cast("array<string>"))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", own.alias("ids"))
    d = d.withColumn("left", F.array_join(F.transform("ids", lambda x: F.concat(F.lit(","), x, F.lit(","))), ""))
    hits = []
    for i, (name, ids) in enumerate(ordered_rules()):
        run = F.lit("".join(f",{x}," for x in ids))
        d = d.withColumns({f"hit{i}": F.when(F.contains("left", run), F.lit(name)), "left": F.replace("left", run, F.lit(",;,"))})
        hits.append(F.col(f"hit{i}"))
    unknown = F.size(F.filter("ids", lambda x: x == "UNKNOWN"))
    other = F.size(F.filter("ids", lambda x: x == "OTHER"))
    names = F.flatten(F.transform(F.filter("ids", lambda x: x.startswith("Name:")), lambda x: F.split(F.substr(x, F.lit(6)), r"\|")))
    found = F.concat(F.array_compact(F.array(*hits)), names)
    own = F.create_map(*[y for i, of in families().items() for y in (F.lit(i), F.array(*[F.lit(z) for z in of]))])
    open_ = F.size(F.filter(F.split("left", ","), lambda x: ~F.coalesce(F.arrays_overlap(F.try_element_at(own, x), found), F.lit(True))))
    return d.select(
        "doc_id",
        (F.size("ids") - unknown - other).alias("n_sentences"),
        (unknown + open_).alias("n_unknown"),
        F.array_join(F.array_distinct(found), ",").alias("licenses"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """The same scan in DuckDB SQL."""
    known = ", ".join(f"('{s}', '{name}')" for name, says in SENTENCES.items() for s in says)
    names = ", ".join(f"('{n}', '{spdx}')" for spdx, says in NAMES.items() for n in says)
    slots = " ".join(f"WHEN regexp_matches(x, '^{said}$') THEN '{name}'" for name, said in SLOTS.items())
    steps, last = [], "t0"
    for i, (name, ids) in enumerate(ordered_rules()):
        run = "".join(f",{x}," for x in ids)
        steps.append(f"t{i + 1} AS (SELECT * EXCLUDE (l), CASE WHEN contains(l, '{run}') THEN '{name}' END AS hit{i}, replace(l, '{run}', ',;,') AS l FROM {last})")
        last = f"t{i + 1}"
    hits = ", ".join(f"hit{i}" for i in range(len(RULES)))
    own = ", ".join(f"('{i}', '{spdx}')" for i, of in families().items() for spdx in of)
    return f"""
WITH known(s, name) AS (VALUES {known}), names(said, spdx) AS (VALUES {names}), own(id, spdx) AS (VALUES {own}),
d AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
c AS (
  SELECT rid, string_split(regexp_replace(translate(regexp_replace(regexp_replace(regexp_replace(chr(10) || text || chr(10), '{STARTS}', chr(30) || '\\1', 'g'),
    '{SPDX_LINE}', '\\1' || chr(30), 'g'), '{ENDS}', chr(30), 'g'), '{UPPER}', '{LOWER}'), '[^a-z0-9.\\x1e]+', ' ', 'g'), chr(30)) AS xs
  FROM d WHERE regexp_matches(text, '{TELLING}')
),
e AS (SELECT rid, unnest(xs) AS x, generate_subscripts(xs, 1) AS pos FROM c),
f AS (SELECT rid, pos, regexp_replace(x, '^[ .]+|[ .]+$', '', 'g') AS x FROM e),
ex AS (SELECT rid, pos, unnest(parts) AS part, generate_subscripts(parts, 1) AS k FROM (
  SELECT rid, pos, string_split_regex(replace(regexp_extract(x, '{NAMED}', 1) || regexp_extract(x, '{NAMED}', 2), ' or later', '#later'), '{PARTED}') AS parts FROM f WHERE regexp_matches(x, '{NAMED}'))),
nm AS (SELECT rid, pos, string_agg(spdx, '|' ORDER BY k) AS spdx FROM (SELECT rid, pos, spdx, min(k) AS k FROM ex
  JOIN names ON said = regexp_replace(regexp_replace(replace(part, '#later', ' or later'), '{BEFORE}', ''), '{BEHIND}', '') GROUP BY 1, 2, 3) GROUP BY 1, 2),
g AS (SELECT rid, pos, coalesce(name, CASE {slots} END, 'Name:' || spdx,
    CASE WHEN regexp_matches(x, '{SUSPECT}') THEN 'UNKNOWN' WHEN NOT regexp_matches(x, '{BETWEEN}') THEN 'OTHER' END) AS id
  FROM f LEFT JOIN known ON s = x LEFT JOIN nm USING (rid, pos) WHERE x <> ''),
h AS (SELECT rid, count(*) FILTER (id NOT IN ('UNKNOWN', 'OTHER')) AS n, count(*) FILTER (id = 'UNKNOWN') AS u, string_agg(',' || id || ',', '' ORDER BY pos) AS l,
  string_split(string_agg(substr(id, 6), '|' ORDER BY pos) FILTER (starts_with(id, 'Name:')), '|') AS named FROM g WHERE id IS NOT NULL GROUP BY rid),
t0 AS (SELECT rid, doc_id, coalesce(n, 0) AS n, coalesce(u, 0) AS u, coalesce(l, '') AS l, coalesce(named, []) AS named FROM d LEFT JOIN h USING (rid)),
{", ".join(steps)},
z AS (SELECT rid, doc_id, n, u, l, list_concat(list_filter([{hits}], lambda x: x IS NOT NULL), named) AS found FROM {last}),
lo AS (SELECT rid, i, bool_or(list_contains(found, spdx)) AS ours FROM (SELECT rid, found, unnest(string_split(l, ',')) AS id, generate_subscripts(string_split(l, ','), 1) AS i FROM z) JOIN own USING (id) GROUP BY 1, 2),
un AS (SELECT rid, count(*) AS n_open FROM lo WHERE NOT ours GROUP BY 1)
SELECT doc_id, CAST(n AS INTEGER) AS n_sentences, CAST(u + coalesce(n_open, 0) AS INTEGER) AS n_unknown,
       array_to_string(list_filter(found, lambda x, i: list_position(found, x) = i), ',') AS licenses
FROM z LEFT JOIN un USING (rid)
"""


ORACLE = oracle()
