"""Operations of a training-data pipeline, one module each.

Nothing else in the library imports this subpackage. ``catalog`` holds the
registered queries, ``oracle`` their SQL where SQL can say them.
"""
