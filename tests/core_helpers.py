"""What several test modules share. Nothing is imported from a conftest: there are several."""

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    """The physical plan; the final one if ``df`` has run."""
    return df._jdf.queryExecution().executedPlan().toString()
