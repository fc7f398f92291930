"""Operators of a training-data pipeline over text and vectors. Nothing else in tileweave imports this."""
