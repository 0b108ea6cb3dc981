"""Paths and files: base / delta layout, manifest, catalog, snapshot scans."""
