"""fluxgrain.streaming"""
