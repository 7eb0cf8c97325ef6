"""What a physical plan contains."""


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
