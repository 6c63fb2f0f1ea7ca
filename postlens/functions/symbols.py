"""Symbols of one character, such as emoji, written as words."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Parts of a larger table; a map is searched from its first entry on.
PARTS = 64
#: So many symbols are looked for one by one, which is faster than a pattern.
SINGLE = 16


def symbol_words(text: Column, words: Mapping[str, str]) -> Column:
    """The text with each symbol of the table replaced by its words, in one pass.

    The words are set apart by a blank from what stands before them, unless that is a blank or the start of the text; what
    follows is left as it is. A null text stays null. Symbols of more than one character raise.
    """
    if not words:
        return text
    if odd := [s for s in words if len(s) != 1]:
        raise ValueError(f"not one character: {odd[:3]}")
    listed = "".join(f"\\x{{{ord(s):X}}}" for s in sorted(words))
    count = PARTS if len(words) > PARTS else 1
    tables = []
    for part in range(count):
        pairs = [("", ""), *((s, w) for s, w in sorted(words.items()) if ord(s) % count == part)]
        tables.append(F.create_map(*[F.lit(x) for pair in pairs for x in pair]))

    def spelled(pieces: Column) -> Column:
        def one(piece: Column, at: Column) -> Column:
            table = tables[0] if count == 1 else F.get(F.array(*tables), F.pmod(F.ascii(piece), F.lit(count)))
            said, before = F.try_element_at(table, piece), F.get(pieces, at - 1)
            apart = F.when(before.isNull() | before.endswith(" "), said).otherwise(F.concat(F.lit(" "), said))
            return F.coalesce(apart, piece)

        return F.array_join(F.transform(pieces, one), "")

    pieces = F.regexp_extract_all(text, F.lit(f"[{listed}]|[^{listed}]+"), F.lit(0))
    # a lambda over one element: the pieces are cut once, though each looks at the one before it
    held = reduce(or_, map(text.contains, words)) if len(words) <= SINGLE else text.rlike(f"[{listed}]")
    return F.when(held, F.get(F.transform(F.array(pieces), spelled), F.lit(0))).otherwise(text)
