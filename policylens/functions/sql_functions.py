"""SQL temporary functions for the rating curves (UDF surface, section 2.13).

They are SQL-bodied functions (``CREATE TEMPORARY FUNCTION ... RETURN``), so
Catalyst inlines them like any expression: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# FIXED VALUES: the breakpoints and factors of the pricing rules.
FUNCTIONS = {
    "credit_factor": ("score DOUBLE", "DOUBLE",
                      "CASE WHEN score >= 800 THEN 0.8D WHEN score >= 740 THEN 0.9D WHEN score >= 670 THEN 1.0D "
                      "WHEN score >= 580 THEN 1.2D ELSE 1.5D END"),
    "insurance_factor": ("score DOUBLE", "DOUBLE",
                         "CASE WHEN score >= 90 THEN 0.8D WHEN score >= 80 THEN 0.9D WHEN score >= 70 THEN 1.0D "
                         "WHEN score >= 60 THEN 1.1D WHEN score >= 50 THEN 1.2D ELSE 1.3D END"),
    "age_risk": ("age INT", "DOUBLE",
                 "CASE WHEN age BETWEEN 16 AND 24 THEN 1.5D - 0.05D * (age - 16) "
                 "WHEN age BETWEEN 25 AND 64 THEN 1.0D + 0.005D * least(age - 25, 65 - age) "
                 "WHEN age BETWEEN 65 AND 99 THEN 1.0D + 0.02D * (age - 65) ELSE 1.5D END"),
    "experience_risk": ("years INT", "DOUBLE",
                        "CASE WHEN years BETWEEN 0 AND 2 THEN 1.5D - 0.1D * years "
                        "WHEN years BETWEEN 3 AND 9 THEN 1.3D - 0.04D * (years - 3) "
                        "WHEN years BETWEEN 10 AND 59 THEN 1.0D ELSE 1.5D END"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    for name, (args, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(FUNCTIONS)
