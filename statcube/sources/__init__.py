"""Readers and writers: files, XML and JSON messages, calendars."""
