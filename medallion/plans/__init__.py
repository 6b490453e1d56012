"""Dataflow specs: from JSON records to spec tables to objects."""
