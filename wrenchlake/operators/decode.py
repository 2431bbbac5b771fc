"""Vehicle decoding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wrenchlake.functions import vehicle
from wrenchlake.functions.dates import first_of_month

DECODED = ["Model", "ModelType", "ModelName", "Plant", "MfgMonth", "MfgYear", "MfgDate", "Country"]


def decode_vehicle(df: DataFrame, chassis: str = "VehicleChassisNumber", product: str = "Product") -> DataFrame:
    """Add model, plant and build-date columns read from chassis code and product.

    Chassis and product come back upper-cased. The coded characters are cut in
    one projection of their own, so the rule chains above refer to them instead
    of repeating the substring work.
    """
    upper = df.withColumns({chassis: F.upper(chassis), product: F.upper(product)})
    slices = {f"_{name}": c for name, c in vehicle.chassis_slices(F.col(chassis)).items()}
    cut = upper.withColumns(
        {
            **slices,
            "_decodable": vehicle.is_decodable(F.col(chassis), F.col(product)),
            "_token": vehicle.model_token(F.col(product)),
        }
    )
    platform, decodable = F.col("_platform"), F.col("_decodable")
    named = cut.withColumn("Model", vehicle.model(F.col("_token"), platform, F.col(product), decodable))
    return (
        named.withColumns(
            {
                "ModelType": vehicle.model_type(platform, F.col(product), decodable),
                "ModelName": vehicle.model_name(F.col("Model"), F.col("_displacement")),
                "Plant": vehicle.plant(platform, F.col("_ninth"), F.col("_eleventh")),
                "MfgMonth": vehicle.mfg_month(platform, F.col("_ninth"), F.col("_eleventh")),
                "MfgYear": vehicle.mfg_year(F.col("_year")),
                "Country": vehicle.country(F.col("_displacement")),
            }
        )
        .withColumn("MfgDate", first_of_month(F.col("MfgYear"), F.col("MfgMonth")))
        .drop(*slices, "_decodable", "_token")
    )
