"""Operators over entity and edge tables; each is a function of DataFrames."""
