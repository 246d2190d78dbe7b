"""Operators of a training-data pipeline over tables of documents.

Every operator takes a DataFrame with at least ``doc_id`` and ``text`` and reads only the columns
it names, so extra columns of any name do no harm. ``queries`` registers one query per operator.
"""
