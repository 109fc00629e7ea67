"""Operators of a training-data pipeline over tables of texts and urls.

Each module holds one operator with its own interface; ``queries`` holds the
thin registered queries and ``oracle`` their SQL twins. Nothing outside this
folder imports it (the entry module adds its queries when it is there).
"""
