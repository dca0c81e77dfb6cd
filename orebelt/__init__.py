"""Medallion analytics over large trip-record tables, built from DataFrame expressions."""
