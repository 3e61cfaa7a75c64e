"""Expressions as SQL text.

Every function here takes SQL expressions (a column name is one) and returns one, to be used with `F.expr`,
`filter` or `selectExpr`. A long expression thus reaches the JVM in one call and runs there without Python.
"""
