"""Display bands for labels, privacy budgets and cluster tendency."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_name(cluster: Column) -> Column:
    """'Outlier' for the noise cluster, the number as text otherwise."""
    return F.when(cluster == -1, F.lit("Outlier")).otherwise(cluster.cast("string"))


def epsilon_band(epsilon: Column) -> Column:
    # Limits and wording of the privacy bands.
    return (
        F.when(epsilon < 0.5, "Very High Privacy")
        .when(epsilon < 2.0, "High Privacy")
        .when(epsilon < 5.0, "Moderate Privacy")
        .otherwise("Low Privacy")
    )


def hopkins_band(hopkins: Column) -> Column:
    # Limits and wording of the tendency bands.
    return (
        F.when(F.isnan(hopkins), "Low cluster tendency - data may be uniform/random")
        .when(hopkins > 0.75, "Strong cluster tendency - data has clear structure")
        .when(hopkins > 0.5, "Moderate cluster tendency - some structure present")
        .otherwise("Low cluster tendency - data may be uniform/random")
    )


def hopkins_gauge(hopkins: Column) -> Column:
    """Gauge segment of the percentage: 0-50, 50-75 or 75-100."""
    share = hopkins * 100
    return F.when(share < 50, "0-50").when(share < 75, "50-75").otherwise("75-100")
