"""Training-data operators: thirteen corpus-scale components and their queries.

Nothing outside this subpackage imports it; ``registry`` holds the query
table and the reference SQL that the repository entry point picks up.
"""
