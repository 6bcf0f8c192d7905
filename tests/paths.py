"""Folders of the driver's test tables."""

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"
