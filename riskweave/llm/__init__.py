"""Training-data operators (text corpora): quality, formatting, mixing, privacy,
decontamination, duplicate removal and token output.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries and their SQL.
"""
