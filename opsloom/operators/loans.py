"""Loan application features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def loan_features(loans: DataFrame) -> DataFrame:
    """Total income, instalment to income ratio and three logarithms."""
    total = F.col("applicant_income") + F.col("coapplicant_income")
    return loans.withColumns({
        "total_income": total,
        "instalment_ratio": F.col("loan_amount") * 1000 / (F.col("term") * (total + 1)),
        "loan_amount_log": F.log1p("loan_amount"), "total_income_log": F.log1p(total),
        "applicant_income_log": F.log1p("applicant_income"),
    })
