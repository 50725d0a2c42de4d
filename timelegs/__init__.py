"""Timetable-leg analytics on Spark DataFrames.

Every public function takes DataFrames (or a session and a path) and returns a
lazy DataFrame; nothing here owns a session or collects row data.
"""
