"""Raw card rows to transaction events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txnguard import constants as K
from txnguard.functions import scalars as X
from txnguard.schemas import EVENT


def _whole(c: str, default: str) -> Column:
    return F.coalesce(F.col(c).cast("long").cast("string"), F.lit(default))


def row_to_event(raw: DataFrame, salt: str) -> DataFrame:
    """One projection. Missing parts of a token read ``nan``; a missing e-mail names the
    merchant ``nan`` and an empty one ``anonymous.com``. Ids come from the row, so a rerun
    gives the same events."""
    product = F.coalesce("ProductCD", F.lit(K.DEFAULT_PRODUCT))
    customer = _whole("card1", "unknown")
    email = F.when(F.col("P_emaildomain") == "", "anonymous.com").otherwise(F.coalesce("P_emaildomain", F.lit("nan")))
    amount = F.coalesce("TransactionAmt", F.lit(0.0))
    fields = {
        "event_id": F.col("TransactionID").cast("string"),
        "event_timestamp_ms": F.lit(K.EPOCH_2017_12_01_MS) + F.coalesce(F.col("TransactionDT").cast("long"), F.lit(0)) * 1000,
        "customer_id": customer,
        "card_token": X.tokenize(F.concat_ws("|", *[_whole(c, "nan") for c in ("card1", "card2", "card3", "card5")]), salt),
        "amount": amount, "currency": F.lit("USD"), "amount_fx_normalised": amount,
        "merchant_id_hash": X.tokenize(F.concat_ws("|", product, _whole("addr1", "nan"), _whole("addr2", "nan")), salt),
        "merchant_name": F.concat(product, F.lit("-MERCHANT-"), email),
        "mcc": X.lookup(product, K.PRODUCT_TO_MCC, K.DEFAULT_MCC),
        "merchant_country": _whole("addr2", "00"),
        "ip_address_hash": X.tokenize(F.concat(F.lit("ip|"), customer), salt),
        "device_fingerprint_hash": X.tokenize(F.concat(F.lit("dev|"), customer), salt),
        "geo_distance_km": F.coalesce("dist1", "dist2", F.lit(0.0)),
        "source_label": F.lit("replayer"), "schema_version": F.lit("v1"),
    }
    return raw.select(*[fields[f.name].cast(f.dataType).alias(f.name) for f in EVENT.fields])
