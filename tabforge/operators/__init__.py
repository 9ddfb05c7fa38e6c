"""Table operators: each is ``f(df, ...) -> DataFrame`` or ``fit(df) -> model``."""
