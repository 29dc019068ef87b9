"""tokenloom: Spark DataFrame operators for token-corpus preparation.

Text and discretised-audio arrays go in, packed and blended training samples come out.
Every operator is DataFrame -> DataFrame (or a Column expression), so plans stay lazy and
Catalyst sees the whole job.
"""
