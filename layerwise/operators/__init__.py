"""Operators: splits, preparation, scoring, sequences, training and evaluation."""
