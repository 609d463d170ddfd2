"""Parcel analytics on Spark: cadastral matching, map-tile shapes and their publication as DataFrame operators."""
