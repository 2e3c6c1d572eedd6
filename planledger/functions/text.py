"""Text predicates, tolerant number parsing and name cleaning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def contains_in_order(col: Column, *parts: str, fold: bool = True) -> Column:
    """Whether ``parts`` occur in ``col`` one after another; ``fold`` ignores case."""

    def plain(part: str) -> str:
        for special in ("\\", "%", "_"):
            part = part.replace(special, "\\" + special)
        return part.upper() if fold else part

    subject = F.upper(col) if fold else col
    return subject.like("%" + "%".join(plain(part) for part in parts) + "%")


#: Plain decimal notation, blanks around it allowed.
_NUMBER = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)\s*$"


def parse_number(col: Column) -> Column:
    """The number a string holds in plain decimal notation, as double; null for words and blanks.

    "NaN", "Infinity", "1d" and "1e3" are words here, though Spark's cast takes them for numbers.
    """
    return F.when(col.rlike(_NUMBER), col.try_cast("double"))


def parse_amount(col: Column, zero_as_null: bool = False) -> Column:
    """The number a string holds, truncated to a whole one (bigint); null for words.

    ``zero_as_null`` blanks the text ``"0"``, which stands for "no promotion".
    """
    value = parse_number(col).try_cast("bigint")
    return F.when(col == "0", None).otherwise(value) if zero_as_null else value


def blank_zeros(col: Column) -> Column:
    """``"0"`` and ``"00"`` mean that no additional discount was agreed."""
    return F.when(col.isin("0", "00"), None).otherwise(col)


def clean_name(col: Column, strip_pipes: bool = False) -> Column:
    """Names pass through as they are; ``strip_pipes`` deletes ``|``."""
    return F.translate(col, "|", "") if strip_pipes else col


def clean_offer_code(col: Column) -> Column:
    """The product key inside an offer code: every ``*``, ``;``, ``R`` and ``C`` goes."""
    return F.translate(col, "*;RC", "")
