"""Operators for training-data pipelines over tables of documents.

Every operator takes frames, names the columns it reads and ignores all others. NULL texts count as empty,
``doc_id`` may repeat or be NULL unless the operator says otherwise, and an empty table gives an empty result.
"""
