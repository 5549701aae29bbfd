"""Expressions over built-in Spark functions.

Every function takes SQL text for its arguments (mostly a column name) and returns
SQL text, to be used with ``F.expr``, ``selectExpr`` or ``where``. Building a plan
then costs one call into the JVM per expression, where a rule with eighty words
would cost hundreds if it were put together from ``Column`` objects.
"""
