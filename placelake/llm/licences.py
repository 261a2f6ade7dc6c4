"""Licence scan: known sentences become identifiers, and identifier sequences are matched with rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Normalised sentences and their identifiers: fixed values, quoted from the licences' texts.
SENTENCES = {
    "released under the mit license": "mit-ref",
    "licensed under the mit license": "mit-ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated"
    " documentation files the software to deal in the software without restriction including without limitation"
    " the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to"
    " permit persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions"
    " of the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to"
    " the warranties of merchantability fitness for a particular purpose and noninfringement": "mit-warranty",
    "licensed under the apache license version 2 0": "apache-ref",
    "licensed under the apache license version 2 0 the license": "apache-head",
    "you may not use this file except in compliance with the license": "apache-comply",
    "you may obtain a copy of the license at": "apache-copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is"
    " distributed on an as is basis without warranties or conditions of any kind either express or implied":
        "apache-warranty",
    "this work is licensed under the gnu general public license version 3": "gpl3-ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
    " public license as published by the free software foundation either version 3 of the license or at your"
    " option any later version": "gpl3-grant",
    "this program is distributed in the hope that it will be useful but without any warranty without even the"
    " implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu general public license for more details": "gpl-see",
    "licensed under cc by nc 4 0": "cc-by-nc-ref",
    "licensed under cc by 4 0": "cc-by-ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-ref",
    "redistributions of source code must retain the above copyright notice this list of conditions and the"
    " following disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the"
    " following disclaimer in the documentation and or other materials provided with the distribution": "bsd-binary",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general"
    " public license as published by the free software foundation either version 2 of the license or at your"
    " option any later version": "gpl2-grant",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general"
    " public license as published by the free software foundation either version 2 1 of the license or at your"
    " option any later version": "lgpl21-grant",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general"
    " public license as published by the free software foundation either version 3 of the license or at your"
    " option any later version": "lgpl3-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general"
    " public license as published by the free software foundation either version 3 of the license or at your"
    " option any later version": "lgpl3-grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general"
    " public license as published by the free software foundation either version 3 of the license or at your"
    " option any later version": "agpl3-grant",
    "this library is distributed in the hope that it will be useful but without any warranty without even the"
    " implied warranty of merchantability or fitness for a particular purpose": "gpl-warranty",
    "see the gnu lesser general public license for more details": "lgpl-see",
    "see the gnu affero general public license for more details": "agpl-see",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the"
    " license": "apache-head-comply",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission": "bsd3-names",
    "this source code form is subject to the terms of the mozilla public license v": "mpl-head",
    "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0": "mpl2-copy",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "mpl2-copy",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby"
    " granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby"
    " granted provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "licensed under cc0 1 0": "cc0-ref",
    "licensed under cc by sa 4 0": "cc-by-sa-ref",
    "this work is licensed under a creative commons attribution sharealike 4 0 international license": "cc-by-sa-ref",
    "all rights reserved": "reserved",
}
#: Licences and the identifier sequences that show them, in order and next to each other among the known sentences.
RULES = [
    ("Apache-2.0", ("apache-ref",)), ("Apache-2.0", ("apache-head", "apache-comply", "apache-copy")),
    ("Apache-2.0", ("apache-comply", "apache-copy", "apache-warranty")), ("BSD-2-Clause", ("bsd-source", "bsd-binary")),
    ("CC-BY-4.0", ("cc-by-ref",)), ("CC-BY-NC-4.0", ("cc-by-nc-ref",)), ("GPL-3.0", ("gpl3-ref",)),
    ("GPL-3.0", ("gpl3-grant", "gpl-warranty", "gpl-see")), ("MIT", ("mit-ref",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")), ("Apache-2.0", ("apache-head-comply", "apache-copy")),
    ("BSD-3-Clause", ("bsd-source", "bsd-binary", "bsd3-names")), ("GPL-2.0", ("gpl2-grant", "gpl-warranty", "gpl-see")),
    ("LGPL-2.1", ("lgpl21-grant", "gpl-warranty", "lgpl-see")), ("LGPL-3.0", ("lgpl3-grant", "gpl-warranty", "lgpl-see")),
    ("AGPL-3.0", ("agpl3-grant", "gpl-warranty", "agpl-see")), ("MPL-2.0", ("mpl-head", "mpl2-copy")),
    ("ISC", ("isc-grant",)), ("CC0-1.0", ("cc0-ref",)), ("CC-BY-SA-4.0", ("cc-by-sa-ref",)),
]
# Every pattern here is flat: a repeated group would go a stack frame deeper for each line of a text. The marks are looked for
# from their first one only, as a long run of them would be read anew from each.
_STOP = r"(?<![.!?])[.!?]++(?:\s++|$)"
_SENTENCE_END = rf"{_STOP}|\n+"


def sentences_of(text: Column) -> Column:
    """Sentences end at a full stop, exclamation or question mark before white space, or at a line's end.

    Normalised: lower case, everything but letters and digits of the basic alphabet to single spaces.
    """
    parts = F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), _SENTENCE_END)
    clean = F.transform(parts, lambda s: F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")))
    return F.filter(clean, lambda s: s != "")


def identifiers_of(text: Column, known: Mapping[str, str]) -> Column:
    """The identifiers of the known sentences, in the text's order.

    A known sentence starts and ends where a sentence or a line does, and may run over single line breaks with
    whatever marks of a comment stand there. Blank lines end it, as do sentences.
    """
    # A bar ends a sentence, a slash a line; those of the text itself count as other marks.
    marked = F.translate(F.lower(F.coalesce(text.cast("string"), F.lit(""))), "|/", ",,")
    steps = ((r"(?md)^[^a-z0-9|\n]++$", ""), (rf"{_STOP}|\n{{2,}}", "|"), (r"\n", "/"), ("[^a-z0-9|/]+", " "), (" ?([|/]) ?", "$1"))
    for pattern, to in steps:
        marked = F.regexp_replace(marked, pattern, to)
    marked = F.concat(F.lit("|"), F.trim(marked), F.lit("|"))
    some = "|".join(x.replace(" ", "[ /]+") for x in sorted(known, key=len, reverse=True))
    ids = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    hits = F.regexp_extract_all(marked, F.lit(f"(?<=[|/])(?:{some})(?=[|/])"), 0)
    return F.transform(hits, lambda s: F.element_at(ids, F.regexp_replace(s, "/+", " ")))


def licences_of(identifiers: Column, rules: Sequence[tuple[str, tuple[str, ...]]]) -> Column:
    """Names of the licences of which a rule's sequence occurs, sorted, without repetition.

    Where a longer rule goes on from a sequence, as BSD-3-Clause does from BSD-2-Clause, the longer one counts alone.
    """
    line = F.concat(F.lit("/"), F.concat_ws("/", identifiers), F.lit("/"))

    def pattern(seq: tuple[str, ...]) -> str:
        longer = ["/".join(x[len(seq):]) for _, x in rules if len(x) > len(seq) and x[:len(seq)] == seq]
        return f"/{'/'.join(seq)}/" + (f"(?!(?:{'|'.join(longer)})/)" if longer else "")

    found = [F.when(line.rlike(pattern(seq)), F.lit(name)) for name, seq in rules]
    return F.array_sort(F.array_distinct(F.array_compact(F.array(*found))))


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  known: Mapping[str, str] = SENTENCES,
                  rules: Sequence[tuple[str, tuple[str, ...]]] = RULES) -> DataFrame:
    """A row per document: id, number of sentences, identifiers in order, and the licences shown.

    One pass without a shuffle. A null or empty text has no sentence, no identifier and no licence (empty
    arrays). Repeated rows give a row each; an empty table gives no rows; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), sentences_of(F.col(f"`{text_col}`")).alias("sentences"),
                       identifiers_of(F.col(f"`{text_col}`"), known).alias("identifiers"))
    return rows.select("doc_id", F.size("sentences").cast("long").alias("n_sentences"), "identifiers",
                       licences_of(F.col("identifiers"), rules).alias("licences"))
