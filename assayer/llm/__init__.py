"""Operations of a training-data pipeline over tables of documents.

Nothing outside this subpackage imports it. ``queries`` registers one query
per operator; ``corpus_pipeline.py`` at the top of the repository chains five.
"""
