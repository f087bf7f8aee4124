"""Readers and writers: page-layout XML, catalogues, image maps, run records, TEI."""
