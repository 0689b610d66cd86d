"""Bronze to Silver: reject, type, mask, project."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from assayer.functions.masking import mask_email, mask_ip
from assayer.operators.contract import EVENT_CONTRACT, Contract, conform


def to_silver(
    bronze: DataFrame,
    contract: Contract = EVENT_CONTRACT,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Cleaned events, one map-only pass; works on batch and streaming input.

    ``carry`` names Bronze columns to keep at the end, such as the commit or
    the file and row a record came from (see ``operators.lineage``). Without
    them the columns are those of the contract.
    """
    return contract.keep(bronze).select(*silver_columns(bronze, contract), *carry)


def silver_columns(bronze: DataFrame, contract: Contract = EVENT_CONTRACT) -> list[Column]:
    """The columns of the contract, made of raw ones."""
    derived = {
        "email_hash": mask_email("email"),
        "ip_masked": mask_ip("ip_address"),
        "processed_at": F.current_timestamp(),
    }
    columns = []
    for f in contract.schema.fields:
        if f.name in derived:
            column = derived[f.name]
        elif bronze.schema[f.name].dataType == f.dataType:
            column = F.col(f.name)
        else:
            column = contract.typed(f.name)
        columns.append(column.alias(f.name))
    return columns


def to_strict_silver(
    bronze: DataFrame,
    contract: Contract = EVENT_CONTRACT,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``to_silver`` with the exact contract schema, for the write boundary.

    The columns named in ``carry`` follow those of the contract as they are. The non-null checks hide column names from filter pushdown, so transforms
    that go on from Silver in the same plan use ``to_silver``.
    """
    carried = [bronze.schema[name] for name in carry]
    schema = StructType([*contract.schema.fields, *carried])
    return conform(to_silver(bronze, contract, carry), schema)
