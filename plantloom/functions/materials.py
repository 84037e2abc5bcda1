"""Rules on materials, plants and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Old material numbers that mark a record as no longer in use.
RETIRED_OLD_NUMBERS = ("ARCHIVE", "DUPLICATE", "RENUMBERED")


def not_retired(old_number: str = "BISMT") -> Column:
    """The old material number is unknown or none of the retirement marks."""
    value = F.col(old_number)
    return value.isNull() | ~value.isin(*RETIRED_OLD_NUMBERS)


def not_deleted(flag: str = "LVORM") -> Column:
    """The deletion flag is null or empty."""
    return F.col(flag).isNull() | (F.col(flag) == "")


def not_split_valued(valuation_type: str = "BWTAR") -> Column:
    """No valuation type at all; an empty one counts as a type."""
    return F.col(valuation_type).isNull()


def plant_label(plant: str = "WERKS", name: str = "NAME1") -> Column:
    """``plant-name``; just the plant where the name is unknown."""
    return F.concat_ws("-", F.col(plant), F.col(name))


def global_material_id(
    global_number: str = "global_material_number", number: str = "MATNR"
) -> Column:
    """The global number, or the local one where that is null or empty."""
    return F.coalesce(F.nullif(F.col(global_number), F.lit("")), F.col(number))


def joined_key(columns: Sequence[str]) -> Column:
    """Values joined by underscores; nulls are left out."""
    return F.concat_ws("_", *[F.col(c) for c in columns])
