"""Readers.  Topic and JDBC readers are thin option builders: the connector
jars come with the cluster; everything downstream takes DataFrames."""
